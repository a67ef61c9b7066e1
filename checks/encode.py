"""Test tables as tagged exports, made with Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.scratch import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; the session runs in UTC, as the oracle does."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(value: Column | str) -> Column:
    """``{S: ...}``, absent for NULL."""
    return _present(value, lambda v: F.struct(v.cast("string").alias("S")))


def number(value: Column | str) -> Column:
    """``{N: ...}``, absent for NULL."""
    return _present(value, lambda v: F.struct(v.cast("string").alias("N")))


def cents(value: Column | str) -> Column:
    """``{N: ...}`` of an amount with two decimals."""
    return number((F.col(value) if isinstance(value, str) else value).cast("decimal(15,2)"))


def minor_units(value: str) -> Column:
    """``{N: ...}`` of an amount in hundredths, a whole number."""
    return number(F.floor(F.col(value) * 100 + 0.5))


def flag(value: Column) -> Column:
    """``{BOOL: ...}``."""
    return _present(value, lambda v: F.struct(v.alias("BOOL")))


def attributes(**values: Column) -> Column:
    """A struct of attributes."""
    return F.struct(*[value.alias(name) for name, value in values.items()])


def mapped(**values: Column) -> Column:
    """``{M: {...}}``."""
    return F.struct(attributes(**values).alias("M"))


def listed(*elements: Column) -> Column:
    """``{L: [...]}``."""
    return F.struct(F.array(*elements).alias("L"))


def text_set(*elements: Column) -> Column:
    """``{SS: [...]}``."""
    return F.struct(F.array(*[e.cast("string") for e in elements]).alias("SS"))


def export(
    df: DataFrame, root: str, folder: str, present: Column | None = None, written: Column | None = None, keys: Column | None = None, **values: Column
) -> str:
    """Write ``df`` as export records below a fresh scratch path and return that path.

    ``folder`` is the part of the path below it; records have the key and write-time
    structs an export has (``keys``, ``written``), which nothing should read but where deletes are
    applied. Where ``present`` is false the root is left out, as in the change record of a delete.
    """
    image = attributes(**values)
    base = scratch_path(df.sparkSession, "export")
    df.select(
        F.struct(F.struct((F.lit("0") if written is None else written.cast("string")).alias("N")).alias("WriteTimestampMicros")).alias("Metadata"),
        (F.struct(F.struct(F.lit("unread").alias("S")).alias("key")) if keys is None else keys).alias("Keys"),
        (image if present is None else F.when(present, image)).alias(root),
    ).write.json(f"{base}/{folder}" if folder else base)
    return base


def _present(value: Column | str, wrap) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return F.when(column.isNotNull(), wrap(column))
