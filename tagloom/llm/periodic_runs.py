"""Periodic runs of words: stretches that repeat themselves at a fixed distance.

A run is a stretch whose words ``q`` apart are identical, at least ``2 * q`` long, that
neither neighbour extends. With ``i`` the first word of a run and ``j = i + q``, the suffixes
at ``i`` and ``j`` share all of the run but its first ``q`` words, so their common prefix is
no shorter than their distance. Such pairs come out of a Kruskal over the suffixes of a
document: neighbours in suffix order are edges as long as their common prefix (LCP), and the
longest are united first, by union-find over ordered sets of positions. Two positions that
become neighbours in a merged set, at a distance the current LCP covers, seed a run: no
position between them shares that prefix, so the distance is the smallest period, and the
LCP says where the run ends. The smaller set moves into the larger, so a document of n words
has O(n log n) such pairs.

A run of ``least`` words or more has an LCP of at least half of that, so shorter edges are
left out, and documents in which no stretch of so many words repeats are left out whole.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagloom.llm.common import WHITE, arrow_id_type, blocks, id_type, keyed, mix, rolling, word_spans

_CHUNK = 1024  # positions of an ordered set that lie in one list


class Positions:
    """An ordered set of positions, in lists of bounded length."""

    def __init__(self, first: int) -> None:
        self._lists, self._last, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for part in self._lists:
            yield from part

    def around(self, x: int) -> tuple[int | None, int | None]:
        """The neighbours ``x`` would have; it is not in the set."""
        at = bisect_left(self._last, x)
        if at == len(self._last):
            return self._last[-1], None
        part = self._lists[at]
        i = bisect_left(part, x)
        return part[i - 1] if i else (self._last[at - 1] if at else None), part[i]

    def add(self, x: int) -> None:
        at = min(bisect_left(self._last, x), len(self._last) - 1)
        part = self._lists[at]
        insort(part, x)
        self._last[at] = part[-1]
        self.size += 1
        if len(part) > _CHUNK:
            half = len(part) // 2
            self._lists[at : at + 1] = [part[:half], part[half:]]
            self._last[at : at + 1] = [part[half - 1], part[-1]]


def new_neighbours(edges: Iterator[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """(i, j, lcp) for positions i < j that become neighbours as the sets of an edge's ends unite.

    ``edges`` are (position, position, lcp) by descending lcp and join no two positions twice.
    """
    parent: dict[int, int] = {}
    sets: dict[int, Positions] = {}

    def find(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    for a, b, lcp in edges:
        a, b = find(a), find(b)
        large, small = sets.get(a) or Positions(a), sets.pop(b, None) or Positions(b)
        if large.size < small.size:
            a, b, large, small = b, a, small, large
            sets.pop(b, None)
        parent[b], sets[a] = a, large
        moved = [(x, *large.around(x)) for x in small]
        for at, (x, left, right) in enumerate(moved):
            # Of positions that move into one gap only the outer ones get new neighbours.
            if left is not None and (at == 0 or moved[at - 1][1] != left):
                yield left, x, lcp
            if right is not None and (at + 1 == len(moved) or moved[at + 1][2] != right):
                yield x, right, lcp
        for x, _, _ in moved:
            large.add(x)


def _classes(sorted_keys: np.ndarray) -> np.ndarray:
    """For each place of sorted keys the first place with the same key."""
    at = np.arange(len(sorted_keys))
    at[1:][sorted_keys[1:] == sorted_keys[:-1]] = 0
    return np.maximum.accumulate(at)


def suffix_order(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions in the order of the suffixes, and for each power of two the ranks of the
    positions by so many words.

    ``words`` are numbers that differ between documents, ``ends`` the end of the document of
    each position. Prefixes are doubled until no two suffixes share one.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    rank = np.empty(n, np.int32)
    first = _classes(words[order])
    rank[order] = first
    levels, width = [rank], 1
    live = order[np.bincount(first, minlength=n)[first] > 1]
    while len(live):
        after = live + width
        second = np.where(after < ends[live], rank[np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
        keys = rank[live].astype(np.int64) * (n + 1) + second
        order = np.argsort(keys, kind="stable")
        live = live[order]
        old = rank[live]
        first = _classes(keys[order])
        rank = rank.copy()
        rank[live] = old + (first - _classes(old))
        levels.append(rank)
        width *= 2
        live = live[np.bincount(first, minlength=len(live))[first] > 1]
    suffixes = np.empty(n, np.int64)
    suffixes[rank] = np.arange(n)
    return suffixes, levels


def common_prefixes(a: np.ndarray, b: np.ndarray, ends: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """How many words the suffixes at ``a`` and ``b`` (of one document each) share."""
    shared = np.zeros(len(a), np.int64)
    last = len(ends) - 1
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + shared, b + shared
        inside = (x < ends[a]) & (y < ends[b])
        same = inside & (levels[level][np.minimum(x, last)] == levels[level][np.minimum(y, last)])
        shared += np.where(same, 1 << level, 0)
    return shared


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words only."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    held = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[WHITE[data]]))]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), held)
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def runs_of(words: np.ndarray, first: np.ndarray, least: int = 12) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document, by start, then period.

    ``words`` are the word numbers of all documents, ``first`` the place of each one's first
    word, with the end of the last.
    """
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(first) - 1)]
    half = max(1, (least + 1) // 2)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if len(words) <= half:
        return found
    # Documents in which the words of half a run occur twice; a hash that collides only adds some.
    grams = mix(rolling(mix(words.astype(np.uint64) + np.uint64(1)), half) + mix(owner[: len(words) - half + 1].astype(np.uint64)))
    inside = owner[: len(grams)] == owner[half - 1 :]
    ordered = np.sort(grams[inside])
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return found
    held = np.zeros(len(found), bool)
    held[owner[: len(grams)][inside & np.isin(grams, again)]] = True
    at = np.flatnonzero(held[owner])
    words, owner = words[at], owner[at]
    ends = np.searchsorted(owner, owner, "right")
    begins = np.searchsorted(owner, owner, "left")
    _, dense = np.unique(owner * (int(words.max()) + 1) + words, return_inverse=True)
    suffixes, levels = suffix_order(dense, ends)
    a, b = suffixes[:-1], suffixes[1:]
    near = owner[a] == owner[b]
    a, b = a[near], b[near]
    lcp = common_prefixes(a, b, ends, levels)
    long = lcp >= half
    a, b, lcp = a[long], b[long], lcp[long]
    order = np.argsort(-lcp, kind="stable")
    edges = zip(a[order].tolist(), b[order].tolist(), lcp[order].tolist())
    seeds = [(i, j - i, shared) for i, j, shared in new_neighbours(edges) if j - i <= shared and j - i + shared >= least]
    for i, period, shared in seeds:
        begin = int(begins[i])
        # The word before would extend the run: it is seeded further left.
        if i == begin or dense[i - 1] != dense[i + period - 1]:
            found[owner[i]].append((i - begin, period + shared, period))
    for runs in found:
        runs.sort(key=lambda run: (run[0], run[2]))
    return found


def _scan(least: int, keep_text: bool, schema: pa.Schema):
    def run(batches):
        for batch, data, at in blocks(batches):
            starts, ends, first = word_spans(data, at, WHITE)
            found = runs_of(word_numbers(data, starts, ends), first, least)
            digests, texts = [], []
            for row, runs in enumerate(found):
                low, n = int(first[row]), int(first[row + 1] - first[row])
                kept = np.arange(low, low + n)
                if runs:
                    gone = np.zeros(n + 1, np.int32)
                    for start, length, period in runs:
                        gone[start + period] += 1
                        gone[start + length] -= 1
                    kept = kept[np.cumsum(gone)[:n] == 0]
                text = b" ".join([data[a:b].tobytes() for a, b in zip(starts[kept], ends[kept])])
                digests.append(hashlib.sha256(text).hexdigest())
                texts.append(text.decode() if keep_text else None)
            each = np.array([run for runs in found for run in runs], np.int64).reshape(-1, 3)
            sizes = np.concatenate(([0], np.cumsum([len(runs) for runs in found]))).astype(np.int32)
            names = [f.name for f in schema.field("runs").type.value_type]
            listed = pa.ListArray.from_arrays(pa.array(sizes), pa.StructArray.from_arrays([pa.array(c) for c in each.T], names))
            yield pa.RecordBatch.from_arrays(
                [batch.column("k_id"), pa.array(np.diff(first).astype(np.int64)), listed, pa.array(digests, pa.string()), pa.array(texts, pa.string())],
                schema=schema,
            )

    return run


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 12, keep_text: bool = True
) -> DataFrame:
    """One row per input row: id, n_words, runs, collapsed_sha256, collapsed.

    A word is a run of characters without ASCII white space, compared unchanged. ``runs``
    lists (start, length, period) of all runs of at least ``least`` words and two periods, by
    start, then period; words are numbered from 0. ``collapsed`` is the text without the words
    that lie in a run behind its first period, joined by spaces (null unless ``keep_text``).

    - Null or empty text: no words, no runs, an empty text left.
    - Very long texts are worked on whole: about four bytes a word for each doubling of the
      longest repeated stretch, and O(n log n) steps even where one word fills the text.
    - Rows are judged each on its own: repeated rows have equal results, null ids are carried
      along, an empty table gives no rows, and other columns are not read.
    """
    texts = keyed(docs, id_col, text_col).select("k_id", "body")
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    out = pa.schema([("k_id", arrow_id_type(texts)), ("n_words", pa.int64()), ("runs", pa.list_(run)),
                     ("collapsed_sha256", pa.string()), ("collapsed", pa.string())])
    ddl = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed_sha256 string, collapsed string"
    return texts.mapInArrow(_scan(least, keep_text, out), f"k_id {id_type(texts)}, {ddl}").withColumnRenamed("k_id", id_col)
