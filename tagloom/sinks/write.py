"""Plain sinks (K1, K2, K5-K8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, DataFrameWriter

from tagloom.functions.names import quoted


def write_table(
    df: DataFrame,
    table: str,
    path: str | None = None,
    *,
    data_format: str = "parquet",
    mode: str = "overwrite",
    files: int | None = None,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Write a catalog table, its database made if need be, and return it read back
    (K1, K3, K8): later steps start from the files, not from the whole plan again."""
    spark = df.sparkSession
    if "." in table:
        database = table.rsplit(".", 1)[0]
        if not spark.catalog.databaseExists(database):
            parts = ".".join(quoted(part) for part in database.split("."))
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {parts}")
    writer = _writer(df, data_format, mode, files, options)
    if path:
        writer = writer.option("path", path)
    _saved(lambda: writer.saveAsTable(table), table)
    return spark.table(table)


def write_files(
    df: DataFrame,
    path: str,
    *,
    data_format: str = "parquet",
    mode: str = "overwrite",
    files: int | None = None,
    options: Mapping[str, Any] | None = None,
) -> None:
    """Write files of any format Spark writes, with its options (K2, K7)."""
    _saved(lambda: _writer(df, data_format, mode, files, options).save(path), path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("year", "month", "day"),
    *,
    data_format: str = "parquet",
    mode: str = "overwrite",
    options: Mapping[str, Any] | None = None,
) -> None:
    """Write a hive-style partitioned folder; only partitions with new rows are replaced (K5).

    Rows are brought together by partition first, so a partition gets few files, and
    adaptive execution splits a partition that is far larger than the rest.
    """
    grouped = df.hint("rebalance", *partition_by)
    writer = _writer(grouped, data_format, mode, None, options)
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    _saved(lambda: writer.save(path), path)


def _writer(
    df: DataFrame, data_format: str, mode: str, files: int | None, options: Mapping[str, Any] | None
) -> DataFrameWriter:
    # repartition, not coalesce: coalesce would run the whole stage before it in `files` tasks (K6)
    shaped = df.repartition(files) if files else df
    return shaped.write.format(data_format).mode(mode).options(**dict(options or {}))


def _saved(write, target: str) -> None:
    try:
        write()
    except Exception as cause:
        raise RuntimeError(f"writing {target} failed") from cause
