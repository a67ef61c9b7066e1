"""Benchmark decontamination: find test phrases in training texts and the spans to remove.

Texts are dealt with in shards of a few million words. A shard's words become symbols: the
words of the benchmark have numbers, and any other word ends a run, since no phrase holds
one; runs shorter than the shortest phrase are left out. An FM-index over the runs finds all
phrases at once by backward search through wavelet-tree ranks, sampled suffix positions turn
the matches into places, and these merge into removal spans per text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tagloom.llm.common import (
    arrow_id_type,
    blocks,
    drop,
    id_type,
    keyed,
    lowered,
    staged,
    word_hashes,
    word_spans,
    word_table,
)
from tagloom.llm.fm_index import FMIndex

#: Word bytes: digits, letters, and all of non-ASCII characters.
_INSIDE = word_table(bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80)))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SHARD = 1 << 21  # symbols of an index


class Phrases:
    """The windows of benchmark items as rows of word numbers."""

    def __init__(self, items: list[tuple[str, str]], length: int):
        self.words: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[int]] = {}
        self.items = [item for item, _ in items]
        for number, (_, text) in enumerate(items):
            words = [self.words.setdefault(w, len(self.words) + 1) for w in _WORD.findall(_ascii_lower(text))]
            width = min(length, len(words))
            for i in range(len(words) - width + 1 if width else 0):
                windows.setdefault(tuple(words[i : i + width]), set()).add(number)
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.rows = np.zeros((len(windows), length), np.int64)
        for row, window in enumerate(windows):
            self.rows[row, : len(window)] = window
        self.owners = [sorted(owners) for owners in windows.values()]
        data = b" ".join(self.words)
        starts, ends, _ = word_spans(np.frombuffer(data, np.uint8), np.array([0, len(data)]), _INSIDE)
        hashes = word_hashes(np.frombuffer(data, np.uint8), starts, ends)
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order + 1
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)] = True

    def numbered(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, 0 for words of no item."""
        out = np.zeros(len(hashes), np.int64)
        maybe = np.flatnonzero(self.seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.searchsorted(self.hashes, hashes[maybe])
        at[at == len(self.hashes)] = 0
        same = self.hashes[at] == hashes[maybe]
        out[maybe[same]] = self.numbers[at[same]]
        return out


def _ascii_lower(text: str | None) -> bytes:
    return (text or "").encode().lower()


class _Shard:
    """Rows whose runs wait for one index."""

    def __init__(self):
        self.ids, self.sigs, self.totals, self.runs, self.at, self.rows = [], [], [], [], [], []
        self.symbols = 0

    def add(self, batch, data, at, phrases: Phrases):
        data = lowered(data)
        starts, ends, first = word_spans(data, at, _INSIDE)
        numbers = np.concatenate((phrases.numbered(word_hashes(data, starts, ends)), [0])) if len(phrases.words) else np.zeros(len(starts) + 1, np.int64)
        counts = np.diff(first)
        owner = np.repeat(np.arange(len(counts)), counts)
        known = numbers[:-1] > 0
        same = np.zeros(len(known) + 1, bool)  # whether a word goes on the run before it
        if len(known):
            same[1:-1] = known[1:] & known[:-1] & (owner[1:] == owner[:-1])
        begin = np.flatnonzero(known & ~same[:-1])
        end = np.flatnonzero(known & ~same[1:]) + 1
        fit = (end - begin) >= (phrases.lengths.min() if len(phrases.lengths) else 1)
        begin, end = begin[fit], end[fit]
        if len(begin):
            sizes = end - begin
            offsets = np.concatenate(([0], np.cumsum(sizes + 1)))
            index = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - begin, sizes + 1)
            stop = np.zeros(offsets[-1], bool)
            stop[offsets[1:] - 1] = True
            self.runs.append(np.where(stop, 0, numbers[np.minimum(index, len(numbers) - 1)]))
            row = np.repeat(owner[begin], sizes + 1)
            self.at.append(index - first[row])
            self.rows.append(row + len(self.totals))
            self.symbols += int(offsets[-1])
        self.ids.append(batch.column("k_id"))
        self.sigs.append(batch.column("k_sig"))
        self.totals.extend(counts.tolist())

    def found(self, phrases: Phrases, schema: pa.Schema) -> pa.RecordBatch:
        rows = len(self.totals)
        spans: list[list[int]] = [[] for _ in range(rows)]
        items: list[list[str]] = [[] for _ in range(rows)]
        if self.symbols:
            runs, at, row = (np.concatenate(x) for x in (self.runs, self.at, self.rows))
            index = FMIndex(runs, len(phrases.words) + 1)
            low, high = index.search(phrases.rows, phrases.lengths)
            hits = high - low
            which = np.repeat(np.arange(len(hits)), hits)
            suffix = np.arange(hits.sum()) - np.repeat(np.cumsum(hits) - hits - low, hits)
            place = index.locate(suffix)
            who, start = row[place], at[place]
            stop = start + phrases.lengths[which]
            order = np.lexsort((start, who))
            for w, a, b in zip(who[order].tolist(), start[order].tolist(), stop[order].tolist(), strict=True):
                span = spans[w]
                if span and a <= span[-1]:
                    span[-1] = max(span[-1], b)
                else:
                    span += [a, b]
            for w, p in np.unique(np.stack((who, which), 1), axis=0).tolist():
                items[w].extend(phrases.items[i] for i in phrases.owners[p])
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays(self.ids), pa.concat_arrays(self.sigs), pa.array(self.totals, pa.int64()),
                pa.array(spans, pa.list_(pa.int64())), pa.array([sorted(set(x) - {None}) for x in items], pa.list_(pa.string())),
            ],
            schema=schema,
        )


def _search(items: list[tuple[str, str]], length: int, schema: pa.Schema):
    def run(batches):
        phrases = Phrases(items, length)
        shard = _Shard()
        for batch, data, at in blocks(batches):
            shard.add(batch, data, at, phrases)
            if shard.symbols >= _SHARD or len(shard.totals) >= 50_000:
                yield shard.found(phrases, schema)
                shard = _Shard()
        if shard.totals:
            yield shard.found(phrases, schema)

    return run


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", length: int = 10, broadcast_bytes: int = 8 << 20, keyed_rows: bool = False,
) -> DataFrame:
    """One row per document: id, n_words, spans, items (with ``keyed_rows`` instead of the id: k_id, k_sig).

    Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII characters. A phrase
    is ``length`` consecutive words of an item; an item with fewer words is one phrase. ``spans``
    holds first word and end of each merged removal span, ``items`` the ids (as text, sorted,
    distinct) of items with an occurring phrase.

    The benchmark reaches the tasks in blocks of at most ``broadcast_bytes`` of text (a larger
    item is a block of its own), by way of the driver, which holds one block at a time. Each
    block is searched for in all documents; where there are several, the results of one are
    written before the next is read, and merged per document at the end.

    - Null or empty texts have no words; items without words have no phrase; an empty
      benchmark contaminates nothing; an empty table gives no rows.
    - Items with a null id are searched and removed, but not listed. Repeated item ids are one
      item. Rows that repeat a document are judged one by one, however many there are.
    - Very long texts are indexed as a shard of their own.
    - Other columns are not read, whatever their names.
    """
    texts = keyed(docs, id_col, text_col)
    kind = id_type(texts)
    out = pa.schema([("k_id", arrow_id_type(texts)), ("k_sig", pa.int64()), ("n_words", pa.int64()),
                     ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
    ddl = f"k_id {kind}, k_sig long, n_words long, spans array<long>, items array<string>"
    blocks_of_items = _item_blocks(benchmark, item_col, item_text_col, broadcast_bytes)
    block, following = next(blocks_of_items, []), next(blocks_of_items, None)
    found = texts.mapInArrow(_search(block, length, out), ddl)
    if following is not None:
        found = first = staged(found, "phrase-block")
        parts = [first]
        while following is not None:
            part = texts.mapInArrow(_search(following, length, out), ddl)
            parts.append(staged(part.where("size(spans) > 0"), "phrase-block"))
            following = next(blocks_of_items, None)
        # Rows equal in id and text have equal results: one of each part stands for them.
        hits = reduce(DataFrame.union, [part.where("size(spans) > 0").dropDuplicates(["k_id", "k_sig"]) for part in parts])
        each = hits.groupBy("k_id", "k_sig").agg(
            F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
            F.array_sort(F.flatten(F.collect_list(F.expr(
                "filter(transform(spans, (x, i) -> named_struct('a', x, 'b', get(spans, i + 1), 'i', i)), s -> s.i % 2 = 0)"
            )))).alias("pairs"),
        )
        merged = F.expr(
            "aggregate(pairs, cast(array() as array<bigint>), (m, s) -> IF(size(m) > 0 AND s.a <= element_at(m, -1), "
            "concat(slice(m, 1, size(m) - 1), array(greatest(element_at(m, -1), s.b))), concat(m, array(s.a, s.b))))"
        )
        told = staged(each.select(F.col("k_id").alias("h_id"), F.col("k_sig").alias("h_sig"), merged.alias("h_spans"), F.col("items").alias("h_items")), "phrase-hits")
        drop(*parts[1:])
        rows = first.join(told, F.col("k_id").eqNullSafe(F.col("h_id")) & (F.col("k_sig") == F.col("h_sig")), "left")
        found = rows.select("k_id", "k_sig", "n_words", F.coalesce("h_spans", "spans").alias("spans"), F.coalesce("h_items", "items").alias("items"))
    key = ["k_id", "k_sig"] if keyed_rows else [F.col("k_id").alias(id_col)]
    return found.select(*key, "n_words", "spans", F.array_sort("items").alias("items"))


def _cut_rows(row_at: str, schema: pa.Schema):
    def run(batches):
        for batch, data, at in blocks(batches):
            spans = batch.column("spans")
            texts, raw = [], data.tobytes()
            for row in range(len(at) - 1):
                low, high = int(at[row]), int(at[row + 1])
                cut = spans[row].as_py() or []
                if not cut:
                    texts.append(raw[low:high].decode())
                    continue
                starts, ends, _ = word_spans(lowered(data[low:high]), np.array([0, high - low]), _INSIDE)
                place, parts = low, []
                for first, end in zip(cut[::2], cut[1::2], strict=True):
                    parts.append(raw[place : low + int(starts[first])])
                    place = low + int(ends[end - 1])
                texts.append(b"".join([*parts, raw[place:high]]).decode())
            yield pa.RecordBatch.from_arrays([batch.column(row_at), pa.array(texts, pa.string()), spans], schema=schema)

    return run


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", length: int = 10, broadcast_bytes: int = 8 << 20,
) -> DataFrame:
    """``docs`` with the removal spans of :func:`contamination` cut out of their texts.

    A span goes from the first byte of its first word to the last byte of its last one; what
    stands between words around it stays. Texts without a span are returned as they are, null
    ones included. All columns and rows are kept.
    """
    found = contamination(docs, benchmark, id_col, text_col, item_col, item_text_col, length, broadcast_bytes, keyed_rows=True)
    spans = staged(found.where("size(spans) > 0").select("k_id", "k_sig", "spans").dropDuplicates(["k_id", "k_sig"]), "phrase-spans")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    texts = keyed(docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("the_id"), F.col(f"`{text_col}`").alias("the_text")), "the_id", "the_text", "row")
    told = spans.select(F.col("k_id").alias("s_id"), F.col("k_sig").alias("s_sig"), "spans")
    joined = texts.join(told, F.col("k_id").eqNullSafe(F.col("s_id")) & (F.col("k_sig") == F.col("s_sig")), "left")
    schema = StructType([texts.schema["row"], StructField("clean", StringType()), StructField("cut", ArrayType(LongType()))])
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in schema.fields])
    cut = joined.select("row", "body", "spans").mapInArrow(_cut_rows("row", arrow), schema)
    text = F.when(F.col("cut").isNull(), F.col("row")[text_col]).otherwise(F.col("clean"))
    return cut.select(*(text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns))


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[list[tuple[str, str]]]:
    """The items in blocks of at most ``limit`` bytes; one of them, and a partition, is in the driver at a time."""
    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL")
    block, size = [], 0
    for row in items.toLocalIterator():
        more = len(row.text.encode())
        if block and size + more > limit:
            yield block
            block, size = [], 0
        size += more
        block.append((row.item, row.text))
    if block:
        yield block
