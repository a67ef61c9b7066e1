"""The shared folder for data that has to outlive the executor that made it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Whether all machines share a folder, by application and folder.
_SHARED: dict[tuple[str, str], bool] = {}


def scratch_root(spark: SparkSession) -> str:
    """Folder the cluster names in ``spark.checkpoint.dir``, or one in its warehouse.

    Where none is named, a local session (tests) gets a fresh one; on a cluster a
    machine-local folder would be lost with its machine. A ``file:`` folder may be a mount
    that all machines share, which its name does not tell: it is tried once. Where it is none, or
    nothing is named, the warehouse is taken, which all machines of a cluster share; that they do is
    tried as well, and if they do not, that is an error.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if context.master.startswith("local"):
        if not named:
            context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
            named = context.getCheckpointDir()
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    for folder in (named, warehouse and warehouse.rstrip("/") + "/tagloom-scratch"):
        if folder and (not folder.startswith(("file:", "/")) or _shared(spark, folder.rstrip("/"))):
            return folder.rstrip("/")
    if named:
        raise RuntimeError(f"spark.checkpoint.dir is local to a machine: {named}")
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def _shared(spark: SparkSession, folder: str) -> bool:
    """Whether what the executors write to ``folder`` is there afterwards, tried once an application."""
    tried = (spark.sparkContext.applicationId, folder)
    if tried not in _SHARED:
        path, parts = f"{folder}/tagloom/shared-{uuid.uuid4().hex}", max(2, spark.sparkContext.defaultParallelism)
        spark.range(0, parts, 1, parts).write.parquet(path)
        _SHARED[tried] = spark.read.schema("id long").parquet(path).count() == parts
        discard(spark, path)
    return _SHARED[tried]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below :func:`scratch_root` that nothing has used before."""
    return f"{scratch_root(spark)}/tagloom/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str = "stage", with_path: bool = False) -> DataFrame | tuple[DataFrame, str]:
    """``df`` written once and read back, so that later steps share one result.

    Parquet rather than ``checkpoint()``: a later step that needs two columns reads two.
    ``with_path`` returns the folder too, for :func:`discard` once its readers are done;
    otherwise, as with checkpoint files, keeping or expiring it is up to its owner.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return (table, path) if with_path else table


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch folders."""
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)
