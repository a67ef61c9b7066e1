"""Helpers of the text operators: row keys, staged tables, words of Arrow batches as numbers."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.pandas.types import to_arrow_type

from tagloom import scratch
from tagloom.llm.shipping import ship

_BLOCK = 1 << 21  # bytes of text that are turned into numbers at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *carried: str) -> DataFrame:
    """(k_id, k_sig, body): the id, a hash of the text and the text ('' for null).

    Id and hash together name a text, so a repeated id is no reason to mix up two texts,
    and rows equal in both have equal results. All other columns are left behind, so
    their names cannot clash with those an operator makes (but for those ``carried``).
    """
    ship(df.sparkSession)
    body = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.select(F.col(f"`{id_col}`").alias("k_id"), body.alias("body"), *carried).select(
        "k_id", F.xxhash64("body").alias("k_sig"), "body", *carried
    )


def same_key(left: DataFrame, right: DataFrame) -> Column:
    return left["k_id"].eqNullSafe(right["k_id"]) & (left["k_sig"] == right["k_sig"])


def one_of_each_id(texts: DataFrame, *carried: str) -> DataFrame:
    """One row per id of :func:`keyed` texts: that of the smallest hash of a text; ``carried`` follow from the id.

    Each task sends at most one row per id, so a repeated id is no hot spot.
    """
    first = F.min_by("body", "k_sig").alias("body")
    return texts.groupBy("k_id").agg(first, *(F.max(c).alias(c) for c in carried))


def id_type(df: DataFrame) -> str:
    return df.schema["k_id"].dataType.simpleString()


def arrow_id_type(df: DataFrame) -> pa.DataType:
    return to_arrow_type(df.schema["k_id"].dataType)


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read back.

    Its shuffle files go as soon as it is written; :func:`drop` deletes the table itself.
    """
    conf = df.sparkSession.conf
    before = conf.get(_CLEAN, None)
    conf.set(_CLEAN, "true")
    path = scratch.scratch_path(df.sparkSession, label)
    try:
        df.write.parquet(path)
    finally:
        conf.unset(_CLEAN) if before is None else conf.set(_CLEAN, before)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def drop(*tables: DataFrame) -> None:
    """Delete staged tables whose readers have all been written."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


# --- texts as bytes -------------------------------------------------------------------------


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its texts (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "body") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with about 2 MB of text each (a longer text makes its own), as bytes and offsets."""
    for batch in batches:
        data, at = texts_of(batch.column(column))
        rows, first = len(at) - 1, 0
        while first < rows:
            last = int(np.searchsorted(at, at[first] + _BLOCK, "right")) - 1
            last = min(max(last, first + 1), rows)
            yield batch.slice(first, last - first), data[at[first] : at[last]], at[first : last + 1] - at[first]
            first = last


def word_table(separators: bytes) -> np.ndarray:
    """For each byte whether it belongs to a word; ``separators`` do not."""
    inside = np.ones(256, bool)
    inside[list(separators)] = False
    return inside


WHITE = word_table(b"\x20\x09\x0a\x0b\x0c\x0d")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return _LOWER[data]


def word_spans(data: np.ndarray, at: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and for each text the number of its first word.

    Words are maximal runs of bytes of ``inside`` within one text. The third result has an
    entry more than there are texts.
    """
    word = inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    before = np.empty_like(word)
    before[:1], before[1:] = False, word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.empty_like(word)
    after[-1:], after[:-1] = False, word[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, at)


# --- hashes ---------------------------------------------------------------------------------

_M64 = (1 << 64) - 1
_RATIO = 0x9E3779B97F4A7C15
_BYTE_BASE = 0xD6E8FEB86659FD93
_CHUNK = 1 << 20


def _mixed(x: int) -> int:
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _M64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _M64
    return x ^ (x >> 31)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    up, down = np.full(n + 1, base, np.uint64), np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


@lru_cache
def _byte_values() -> np.ndarray:
    return np.array([_mixed((i + 1) * _RATIO & _M64) for i in range(256)], np.uint64)


def _room(n: int) -> int:
    return max(_CHUNK, 1 << (n - 1).bit_length())


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, the same in every process."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(int(np.searchsorted(ends, starts[first] + _CHUNK, "right")), first + 1)
        low = starts[first]
        s, e = starts[first:last] - low, ends[first:last] - low
        up, down = _powers(_BYTE_BASE, _room(int(e[-1])))
        values = _byte_values()[data[low : low + e[-1]]]
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        out[first:last] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


def rolling(values: np.ndarray, length: int, base: int = 0xA0761D6478BD642F) -> np.ndarray:
    """Rabin-Karp hash (modulo 2**64) of each ``length`` consecutive values."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for low in range(0, n, _CHUNK):
        high = min(low + _CHUNK, n)
        part = values[low : high + length - 1]
        up, down = _powers(base, _room(len(part)))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        out[low:high] = (sums[length:] - sums[:-length]) * down[: high - low]
    return out
