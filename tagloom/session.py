"""Session settings for runs over large inputs."""

from __future__ import annotations

_TASK_BYTES = 256 * 1024 * 1024


def settings(input_bytes: int | None = None) -> dict[str, str]:
    """Settings for ``SparkSession.builder.config``.

    Adaptive execution merges small shuffle partitions and splits skewed ones, but it
    starts from the number of partitions given: with ``input_bytes``, one per 256 MB,
    so that no task has to spill. All else is left at Spark's defaults; the operators
    need neither the legacy time parser nor another serializer.
    """
    chosen = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(_TASK_BYTES),
        "spark.sql.session.timeZone": "UTC",
    }
    if input_bytes is not None:
        chosen["spark.sql.shuffle.partitions"] = str(max(200, -(-input_bytes // _TASK_BYTES)))
    return chosen
