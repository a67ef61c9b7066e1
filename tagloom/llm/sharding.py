"""Jump consistent hashing of stable keys to shards, in DataFrame expressions only.

A key walks through ever larger shard numbers, drawn from a linear congruential sequence
that starts at the key; its shard is the last number below the shard count. Raising the
count can only add one more step at the end of the walk, so a row either stays or moves to
the new shard, and no table of ring positions is kept.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import staged

#: Multiplier of the 64-bit congruential sequence of the published algorithm (increment 1).
_MULTIPLIER = 2862933555777941757
_LOW, _HIGH = _MULTIPLIER & 0xFFFFFFFF, _MULTIPLIER >> 32
_MASK = 0xFFFFFFFF


def _next_state(high: Column, low: Column) -> tuple[Column, Column]:
    """state * multiplier + 1 modulo 2**64, in halves of 32 bits so that no product overflows."""
    m0, m1 = _LOW & 0xFFFF, _LOW >> 16
    upper = low * F.lit(m1)
    sum_low = low * F.lit(m0) + F.shiftleft(upper.bitwiseAND(F.lit(0xFFFF)), 16) + F.lit(1)
    carry = F.shiftrightunsigned(sum_low, 32) + F.shiftrightunsigned(upper, 16)
    cross = (low * F.lit(_HIGH)).bitwiseAND(F.lit(_MASK))
    high_part = high * F.lit(m0) + F.shiftleft((high * F.lit(m1)).bitwiseAND(F.lit(0xFFFF)), 16)
    return (carry + cross + high_part).bitwiseAND(F.lit(_MASK)), sum_low.bitwiseAND(F.lit(_MASK))


def _as_long(value: int) -> Column:
    return F.lit(value).cast("long")


def jump_walk(key: Column, shards: int) -> Column:
    """Struct (shard, grown): the key's shard among ``shards`` and among one more.

    ``key`` is a long, read as 64 unsigned bits. The walk is a fold over the largest number
    of steps it can take; once past the last shard it stands still.
    """
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(_as_long(_MASK)).alias("low"),
        _as_long(0).alias("shard"), _as_long(0).alias("grown"), _as_long(0).alias("at"),
    )

    def step(s: Column, _: Column) -> Column:
        live = s["at"] <= shards
        high, low = _next_state(s["high"], s["low"])
        draw = F.shiftrightunsigned(high, 1) + 1
        # The quotient of the published algorithm, in double precision.
        onward = F.floor((s["at"] + 1).cast("double") * (F.lit(float(1 << 31)) / draw.cast("double")))
        return F.when(
            live,
            F.struct(
                high.alias("high"), low.alias("low"),
                F.when(s["at"] < shards, s["at"]).otherwise(s["shard"]).alias("shard"),
                s["at"].alias("grown"), onward.alias("at"),
            ),
        ).otherwise(s)

    return F.aggregate(F.sequence(F.lit(0), F.lit(shards)), start, step, lambda s: F.struct(
        s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")
    ))


def stable_key(column: Column, kind: str) -> Column:
    """A long that stands for the value of a key column: integers as they are, all else by xxhash64.

    A null key is the key 0, as good as any other.
    """
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(column.cast("long"), F.lit(0).cast("long"))
    return F.when(column.isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64(column.cast("string")))


def jump_shards(
    docs: DataFrame, shards: int = 16, key_col: str = "doc_id", text_col: str = "text", buckets: int = 256, splits: int = 8
) -> DataFrame:
    """One row per input row: key, size, text_crc32, law, shard, slot, grown_shard.

    ``shard`` follows from the key and the number of shards alone; ``grown_shard`` is the
    shard with one more of them. ``slot`` numbers the rows of a shard from 0 without gaps, by
    (key modulo ``buckets``, checksum modulo ``splits``, key, checksum, size): each such bucket
    of a shard is numbered on its own and moved up by the rows of those before it, so no task
    holds a whole shard, and the texts of a repeated key are spread too. Rows that are equal in all
    of these are numbered by the part of the input they are in, so one row that is repeated over
    a third of the table is spread as well. ``size`` is the text's UTF-8 bytes plus 1, so that
    empty documents count too. The walk takes up to ``shards`` + 1 interpreted steps a row: fit
    for tens of shards, slow for thousands.

    - Null text: size 1, checksum of no bytes. Null key: the shard of key 0; all null keys
      share one bucket, and null keys sort first.
    - Repeated keys share a shard and have slots of their own; equal rows are
      interchangeable.
    - Empty table: no rows. Other columns are not read.
    """
    kind = docs.schema[key_col].dataType.simpleString()
    body = F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "UTF-8")
    key = stable_key(F.col("key"), kind)
    rows = docs.select(
        F.col(f"`{key_col}`").alias("key"), (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body).alias("text_crc32")
    )
    placed = staged(
        rows.withColumn("walk", jump_walk(key, shards)).select(
            "key", "size", "text_crc32", F.col("walk.shard").alias("shard"), F.col("walk.grown").alias("grown_shard"),
            (F.pmod(key, F.lit(buckets)) * splits + F.pmod("text_crc32", F.lit(splits))).cast("int").alias("bucket"),
            F.spark_partition_id().alias("lane"),
        ),
        "shards",
    )
    return _numbered(placed).select(
        F.col("key").alias(key_col), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def _numbered(placed: DataFrame) -> DataFrame:
    """``slot`` of each row within its shard.

    A cell is the equal rows of one lane, a part of the input: rows are numbered within their cell, and
    cells, one short row each, within their bucket.
    """
    same = ["shard", "bucket", "key", "text_crc32", "size", "lane"]
    cells = placed.groupBy(*same).agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard", "bucket").orderBy("key", "text_crc32", "size", "lane").rowsBetween(Window.unboundedPreceding, -1)
    cells = staged(cells.withColumn("first", F.coalesce(F.sum("rows").over(before), F.lit(0))), "shard-cells")
    counts = cells.groupBy("shard", "bucket").agg(F.sum("rows").alias("rows"))
    above = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most shards * buckets * splits short rows, whatever the input.
    offsets = staged(counts.select("shard", "bucket", F.coalesce(F.sum("rows").over(above), F.lit(0)).alias("offset")), "shard-offsets")
    # Which of equal rows gets which number makes no difference.
    numbered = placed.withColumn("nth", F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0))))
    start = cells.select(*(F.col(c).alias(f"c_{c}") for c in same), "first")
    met = [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in same]
    joined = numbered.join(start, reduce(and_, met)).join(F.broadcast(offsets), ["shard", "bucket"])
    return joined.withColumn("slot", F.col("offset") + F.col("first") + F.col("nth") - 1)
