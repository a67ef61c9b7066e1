"""Removal of passages that occur more than once anywhere in a corpus.

Every window of ``length`` consecutive words has a Rabin-Karp hash; Spark counts the hashes,
and the words that repeated windows cover are merged into maximal removal intervals.

Counting all windows of a large corpus would shuffle several times its size, so windows that
cannot repeat are ruled out first. The smallest hash of the ``anchor``-word grams inside a
window depends on the window's words alone: equal windows have equal minima. About one gram
in fifteen is such a minimum of any window. These are counted over all texts, and only
windows whose minimum occurs more than once go on to be hashed and counted themselves.

Texts that occur in several rows need no counting: each of their windows occurs again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import (
    WHITE,
    arrow_id_type,
    blocks,
    drop,
    id_type,
    keyed,
    mix,
    rolling,
    staged,
    word_hashes,
    word_spans,
)

_SECOND = 0xC2B2AE3D27D4EB4F


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of each ``width`` consecutive values."""
    span = 1
    while span * 2 <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    return pick(values[: len(values) - (width - span)], values[width - span :]) if width > span else values


def _minima(words: np.ndarray, owner: np.ndarray, length: int, anchor: int):
    """Grams, the smallest one of each window, and which windows lie within one text."""
    grams = mix(rolling(words, anchor))
    if len(words) < length:
        return grams, np.zeros(0, np.uint64), np.zeros(0, bool)
    inner = length - anchor + 1
    return grams, _sliding(grams, inner, np.minimum), owner[: len(words) - length + 1] == owner[length - 1 :]


def _numbered(data, at):
    starts, ends, first = word_spans(data, at, WHITE)
    return starts, ends, first, word_hashes(data, starts, ends), np.repeat(np.arange(len(at) - 1), np.diff(first))


def _lists(values: np.ndarray, owner: np.ndarray, rows: int, kind: pa.DataType) -> pa.Array:
    """The values of each row as a list; ``owner`` ascends."""
    offsets = np.searchsorted(owner, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


_KEY = [("t1", pa.int64()), ("t2", pa.int64())]
_WINDOWS = pa.schema([*_KEY, ("starts", pa.list_(pa.int32())), ("h1", pa.list_(pa.int64())), ("h2", pa.list_(pa.int64()))])


def _find_anchors(length: int, anchor: int, schema: pa.Schema):
    def run(batches):
        for batch, data, at in blocks(batches):
            _, _, _, words, owner = _numbered(data, at)
            grams, smallest, inside = _minima(words, owner, length, anchor)
            inner, rows = length - anchor + 1, len(at) - 1
            if len(smallest):
                # A gram is wanted if it is the minimum of a window around it.
                bounds = np.zeros(len(grams) + inner - 1, np.uint64)
                bounds[inner - 1 : inner - 1 + len(smallest)] = np.where(inside, smallest, 0)
                wanted = np.flatnonzero((_sliding(bounds, inner, np.maximum) == grams) & (grams > 0))
            else:
                wanted = np.zeros(0, np.int64)
            lists = _lists(grams[wanted].view(np.int64), owner[wanted], rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("k_id"), batch.column("t1"), batch.column("t2"), lists], schema=schema
            )

    return run


def _hash_windows(length: int, anchor: int):
    def run(batches):
        for batch, data, at in blocks(batches):
            _, _, first, words, owner = _numbered(data, at)
            _, smallest, inside = _minima(words, owner, length, anchor)
            keep = np.zeros(len(smallest), bool)
            for row, again in enumerate(batch.column("anchors")):
                low, high = first[row], first[row + 1] - length + 1
                if high > low:
                    keep[low:high] = np.isin(smallest[low:high], again.values.to_numpy(zero_copy_only=False).view(np.uint64))
            at_word = np.flatnonzero(keep & inside)
            rows = len(at) - 1
            who = owner[at_word] if len(at_word) else at_word
            h1 = mix(rolling(words, length))[at_word] if len(at_word) else np.zeros(0, np.uint64)
            h2 = mix(rolling(words, length, _SECOND))[at_word] if len(at_word) else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("t1"), batch.column("t2"),
                    _lists((at_word - first[who]).astype(np.int32), who, rows, pa.int32()),
                    _lists(h1.view(np.int64), who, rows, pa.int64()),
                    _lists(h2.view(np.int64), who, rows, pa.int64()),
                ],
                schema=_WINDOWS,
            )

    return run


def _apply(length: int, keep_text: bool, schema: pa.Schema):
    def run(batches):
        for batch, data, at in blocks(batches):
            starts, ends, first = word_spans(data, at, WHITE)
            total, removed, digests, texts, spans = [], [], [], [], []
            copies, again = batch.column("copies").to_pylist(), batch.column("starts")
            for row in range(len(at) - 1):
                low, n = first[row], int(first[row + 1] - first[row])
                gone = np.zeros(n + 1, np.int32)
                if copies[row] > 1 and n >= length:
                    gone[0], gone[n] = 1, -1
                elif again[row].is_valid:
                    windows = again[row].values.to_numpy(zero_copy_only=False)
                    np.add.at(gone, windows, 1)
                    np.add.at(gone, windows + length, -1)
                covered = np.cumsum(gone)[:n] > 0
                edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False]))))
                kept = low + np.flatnonzero(~covered)
                text = b" ".join([data[a:b].tobytes() for a, b in zip(starts[kept], ends[kept], strict=True)])
                total.append(n)
                removed.append(n - len(kept))
                digests.append(hashlib.sha256(text).hexdigest())
                spans.append(edges.tolist())
                texts.append(text.decode() if keep_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("k_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(digests, pa.string()), pa.array(spans, pa.list_(pa.int64())), pa.array(texts, pa.string())],
                schema=schema,
            )

    return run


def repeated_passages_removed(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 35, anchor: int = 8, keep_text: bool = True
) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, removed, kept.

    A word is a run without ASCII white space, compared unchanged. Each word inside a window
    of ``length`` words that also starts elsewhere, in any row, is removed; windows are judged
    on the input. ``removed`` lists the maximal removal intervals as alternating first word and
    end, ``kept`` is the rest joined by spaces (null unless ``keep_text``).

    - Null or empty text, or fewer than ``length`` words: nothing is removed.
    - Equal texts, whatever their ids, repeat each other: both lose all their windows' words.
    - Null ids are carried along; an empty table gives no rows; other columns are not read.
    """
    # A text is known by two hashes; k_sig is one of them.
    texts = keyed(docs, id_col, text_col).select("k_id", F.col("k_sig").alias("t1"), F.xxhash64(F.lit(1), "body").alias("t2"), "body")
    kind = id_type(texts)
    first = pa.schema([("k_id", arrow_id_type(texts)), *_KEY, ("anchors", pa.list_(pa.int64()))])
    anchors = staged(
        texts.mapInArrow(_find_anchors(length, anchor, first), f"k_id {kind}, t1 long, t2 long, anchors array<long>")
        .groupBy("t1", "t2")
        .agg(F.count("*").alias("copies"), F.min("k_id").alias("k_id"), F.first("anchors").alias("anchors")),
        "dedup-anchors",
    )
    found = anchors.select("t1", "t2", "k_id", F.explode("anchors").alias("anchor"))
    again = staged(found.groupBy("anchor").agg(F.count("*").alias("c")).where("c > 1").select("anchor"), "dedup-again")
    hits = staged(found.join(again, "anchor").groupBy("t1", "t2").agg(F.first("k_id").alias("k_id"), F.collect_set("anchor").alias("anchors")), "dedup-hits")
    # One of the rows of a text stands for all: the others would only repeat its windows.
    one = hits.select("t1", "t2", F.col("k_id").alias("one"), "anchors").hint("shuffle_hash")
    windows = staged(
        texts.withColumnRenamed("t1", "u1").withColumnRenamed("t2", "u2")
        .join(one, (F.col("t1") == F.col("u1")) & (F.col("t2") == F.col("u2")) & F.col("k_id").eqNullSafe(F.col("one")))
        .select("t1", "t2", "anchors", "body")
        .mapInArrow(_hash_windows(length, anchor), "t1 long, t2 long, starts array<int>, h1 array<long>, h2 array<long>")
        .where("size(starts) > 0"),
        "dedup-windows",
    )
    drop(again, hits)
    each = windows.select("t1", "t2", F.explode(F.arrays_zip("starts", "h1", "h2")).alias("w")).select(
        "t1", "t2", F.col("w.starts").alias("start"), F.col("w.h1").alias("h1"), F.col("w.h2").alias("h2")
    )
    counted = each.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2")
    repeated = staged(counted, "dedup-repeated")
    starts = staged(each.join(repeated, ["h1", "h2"]).groupBy("t1", "t2").agg(F.collect_list("start").alias("starts")), "dedup-starts")
    drop(windows, repeated)
    spans = staged(anchors.where("copies > 1").select("t1", "t2", "copies").join(starts, ["t1", "t2"], "full"), "dedup-spans")
    drop(anchors, starts)
    out = pa.schema([("k_id", arrow_id_type(texts)), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("kept_sha256", pa.string()), ("removed", pa.list_(pa.int64())), ("kept", pa.string())])
    judged = texts.join(spans.hint("shuffle_hash"), ["t1", "t2"], "left").select("k_id", "body", F.coalesce("copies", F.lit(1)).alias("copies"), "starts")
    return judged.mapInArrow(
        _apply(length, keep_text, out),
        f"k_id {kind}, n_words long, n_removed long, kept_sha256 string, removed array<long>, kept string",
    ).withColumnRenamed("k_id", id_col)
