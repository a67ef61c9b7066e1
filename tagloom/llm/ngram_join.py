"""Exact self-join of texts on the Jaccard similarity of their word n-grams.

Rare-first prefix filtering: the n-grams of a text are put in one global order, rare ones
first, and two sets that are similar enough must share an n-gram among the first few of
each (the prefix). Prefixes are joined on their n-grams; a pair survives the length filter
(sizes too different), the positional filter (too little left behind the first common
n-gram) and the suffix filter (partitions of the rest differ too much), and is then
verified once by counting its common n-grams.

Any global order gives exact results. This one ranks an n-gram by the count of its bin of
2**18, summed over all texts, so the table that every task needs has a fixed size.

Groups of near copies are not expanded into all pairs. Texts with equal sets are one node.
In a first round each text meets the lead of each prefix n-gram only. In the second,
pairs are formed between different components of the links found so far, which leaves no
link between two components unseen: what is skipped is connected already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import (
    WHITE, arrow_id_type, blocks, drop, id_type, keyed, lowered, mix, rolling, staged, word_hashes, word_spans,
)
from tagloom.llm.components import connected_components

_BITS = 18


def _shingles(data: np.ndarray, at: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of the n-grams of each text."""
    data = lowered(data)
    starts, ends, first = word_spans(data, at, WHITE)
    words = word_hashes(data, starts, ends)
    grams = mix(rolling(words, n))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:  # the whole sequence, told apart from longer ones by its length
            yield mix(rolling(words[a:b], b - a) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def _bin(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - _BITS)).astype(np.int64)


def _signatures(n: int, kind: pa.DataType, schema: pa.Schema):
    def run(batches):
        bins = np.zeros(1 << _BITS, np.int64)
        for batch, data, at in blocks(batches):
            first, second, sizes = [], [], []
            all_grams = list(_shingles(data, at, n))
            bins += np.bincount(_bin(np.concatenate(all_grams)), minlength=1 << _BITS)
            for grams in all_grams:
                first.append(int(mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)))
                second.append(int(mix(grams + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)))
                sizes.append(len(grams))
            rows = len(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("k_id"), batch.column("k_sig"),
                    pa.array(np.array(first, np.uint64).view(np.int64)),
                    pa.array(np.array(second, np.uint64).view(np.int64)),
                    pa.array(np.array(sizes, np.int64)),
                    pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.int64()),
                ],
                schema=schema,
            )
        used = np.flatnonzero(bins)
        for low in range(0, len(used), 1 << 16):
            part = used[low : low + (1 << 16)]
            none = pa.nulls(len(part), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(part), kind), none, none, none, none,
                 pa.array(part.astype(np.int32)), pa.array(bins[part])],
                schema=schema,
            )

    return run


def _prefixes(n: int, percent: int, ranks: bytes, schema: pa.Schema):
    def run(batches):
        rank = np.frombuffer(ranks, np.uint8)
        for batch, data, at in blocks(batches):
            tokens, places, sizes, counts = [], [], [], []
            for grams in _shingles(data, at, n):
                size = len(grams)
                keep = size - (percent * size + 99) // 100 + 1 if size else 0
                order = np.argsort(rank[_bin(grams)], kind="stable")[:keep]
                tokens.append(grams[order])
                places.append(np.arange(keep, dtype=np.int32))
                sizes.append(np.full(keep, size, np.int32))
                counts.append(keep)
            rows = np.repeat(np.arange(len(counts)), counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens).view(np.int64)), batch.column("k_id").take(pa.array(rows)),
                 pa.array(np.concatenate(sizes)), pa.array(np.concatenate(places))],
                schema=schema,
            )

    return run


def _sets(n: int, schema: pa.Schema):
    def run(batches):
        for batch, data, at in blocks(batches):
            yield pa.RecordBatch.from_arrays(
                [batch.column("k_id"), pa.array([x.tobytes() for x in _shingles(data, at, n)], pa.binary())],
                schema=schema,
            )

    return run


def _too_far(x: np.ndarray, y: np.ndarray, most: int, depth: int) -> bool:
    """Suffix filter: whether the sorted sets surely differ in more than ``most`` members.

    Splits both at the middle member of x; members on different sides cannot be common, so
    the differences in size of the parts add up to a lower bound.
    """

    def least(x, y, most, depth):
        gap = abs(len(x) - len(y))
        if gap > most or depth == 0 or not len(x) or not len(y):
            return gap
        pivot = x[len(x) // 2]
        i, j = np.searchsorted(x, pivot), np.searchsorted(y, pivot)
        low = least(x[:i], y[:j], most - abs((len(x) - i) - (len(y) - j)), depth - 1)
        return low + least(x[i:], y[j:], most - low, depth - 1)

    return least(x, y, most, depth) > most


def _verify(percent: int, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                total = len(x) + len(y)
                need = -(-percent * total // (100 + percent))
                if _too_far(x, y, total - 2 * need, 3):
                    linked.append(False)
                    continue
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (total - common))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], schema=schema)

    return run


def _possible(n1: Column, n2: Column, i1: Column, i2: Column, percent: int) -> Column:
    """Length and positional filter of two sets that share an n-gram at these positions.

    The n-gram is taken for the first one they share, so no more than what follows in either
    set can be common. A pair that links passes at the n-gram that is its first.
    """
    small, large = F.least(n1, n2), F.greatest(n1, n2)
    return (100 * small >= percent * large) & ((100 + percent) * F.least(n1 - i1, n2 - i2) >= percent * (n1 + n2))


def jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, percent: int = 85
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, text_hash.

    Two documents link when 100 * common >= percent * all of their distinct n-grams of words
    (A-Z lower-cased, split at ASCII white space); ``component_id`` is the smallest id that
    links lead to, the document's own included.

    - Fewer than ``n`` words: the whole sequence is the only n-gram. No words, empty or null
      text: n_shingles 0, linked with nothing.
    - A null id takes part in no link; its component is null.
    - Rows that repeat an id are texts of one document: each row is returned with the size of
      its own set, all with one component. Ties (equal sets) are links like any other.
    - Empty table: no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    texts = keyed(docs, id_col, text_col)
    kind = id_type(texts)
    arrow_id = arrow_id_type(texts)
    first = pa.schema([("k_id", arrow_id), ("k_sig", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
                       ("n", pa.int64()), ("bin", pa.int32()), ("c", pa.int64())])
    passed = staged(
        texts.mapInArrow(_signatures(n, arrow_id, first), f"k_id {kind}, k_sig long, s1 long, s2 long, n long, bin int, c long"),
        "ngram-sets",
    )
    sets = passed.where("bin IS NULL").select("k_id", "k_sig", "s1", "s2", "n")
    counts = np.zeros(1 << _BITS, np.int64)
    for row in passed.where("bin IS NOT NULL").groupBy("bin").agg(F.sum("c").alias("c")).toLocalIterator():
        counts[row.bin] = row.c  # at most 2**18 rows, whatever the input
    # Steps of an eighth of a power of two tell shared n-grams from single ones in a full bin.
    ranks = np.minimum(255, np.log2(counts + 1) * 8).astype(np.uint8).tobytes()

    # One node per distinct set, named by its smallest id.
    some = sets.where("n > 0 AND k_id IS NOT NULL")
    names = staged(some.groupBy("s1", "s2", "n").agg(F.min("k_id").alias("node"), F.min_by("k_sig", F.struct("k_id", "k_sig")).alias("node_sig")), "ngram-nodes")
    nodes = names.select(F.col("node").alias("k_id"), F.col("node_sig").alias("k_sig")).distinct()
    node_texts = texts.join(nodes.hint("shuffle_hash"), ["k_id", "k_sig"], "left_semi")

    prefix_schema = pa.schema([("token", pa.int64()), ("k_id", arrow_id), ("n", pa.int32()), ("i", pa.int32())])
    prefixes = staged(
        node_texts.select("k_id", "body").mapInArrow(_prefixes(n, percent, ranks, prefix_schema), f"token long, k_id {kind}, n int, i int"),
        "ngram-prefixes",
    )
    met = staged(
        prefixes.groupBy("token").agg(F.min("k_id").alias("low"), F.max("k_id").alias("high")).where("low < high").select("token"), "ngram-met"
    )
    shared = staged(prefixes.join(met, "token"), "ngram-shared")
    drop(prefixes, met)
    # An n-gram's lead is the text that has most of its prefix in common with others: among
    # copies with edits of their own, the one nearest to what was copied.
    common = F.count("*") / F.first(F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)
    standing = shared.groupBy("k_id").agg(common.alias("common"))
    leads = staged(
        shared.join(standing, "k_id").groupBy("token").agg(F.min_by(F.struct("k_id", "n", "i"), F.struct(-F.col("common"), "k_id")).alias("lead")),
        "ngram-leads",
    )

    set_schema = pa.schema([("k_id", arrow_id), ("grams", pa.binary())])
    pair_schema = pa.schema([("a", arrow_id), ("b", arrow_id)])

    def verified(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.col("a").alias("k_id")).union(pairs.select("b")).distinct()
        wanted = texts.join(ids.hint("shuffle_hash"), "k_id", "left_semi")
        grams = staged(wanted.select("k_id", "body").mapInArrow(_sets(n, set_schema), f"k_id {kind}, grams binary"), "ngram-grams")
        both = pairs.join(grams.select(F.col("k_id").alias("a"), F.col("grams").alias("set_a")), "a").join(
            grams.select(F.col("k_id").alias("b"), F.col("grams").alias("set_b")), "b"
        )
        linked = staged(both.select("a", "b", "set_a", "set_b").mapInArrow(_verify(percent, pair_schema), f"a {kind}, b {kind}"), "ngram-linked")
        drop(grams)
        return linked

    # Round 1: each text with the lead of each of its prefix n-grams.
    lead = F.col("lead")
    tried = staged(
        shared.join(leads, "token").where(F.col("k_id") != lead["k_id"])
        .where(_possible(F.col("n"), lead["n"], F.col("i"), lead["i"], percent))
        .select(F.col("k_id").alias("a"), lead["k_id"].alias("b")).distinct(),
        "ngram-pairs",
    )
    # Texts of one document are connected, whatever their sets.
    own = some.groupBy("k_id").agg(F.count("*").alias("texts")).where("texts > 1").select("k_id")
    several = some.join(own, "k_id", "left_semi").join(names.select("s1", "s2", "n", "node"), ["s1", "s2", "n"])
    tied = several.where("node <> k_id").select(F.col("k_id").alias("a"), F.col("node").alias("b"))
    first_links = verified(tried)
    links = staged(first_links.union(tied).distinct(), "ngram-links")
    drop(first_links)
    known = staged(connected_components(links), "ngram-components")

    # Round 2: pairs between different components.
    placed = shared.select("token", "k_id", "n", "i").join(known.withColumnRenamed("id", "k_id"), "k_id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "k_id"))
    mixed = staged(placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token"), "ngram-mixed")
    left = staged(placed.join(mixed, "token"), "ngram-left")
    drop(shared, mixed)
    other = left.select(*(F.col(c).alias(f"{c}2") for c in left.columns))
    crossing = (
        left.join(other, (F.col("token") == F.col("token2")) & (F.col("component") > F.col("component2")))
        .where(_possible(F.col("n"), F.col("n2"), F.col("i"), F.col("i2"), percent))
        .select(F.greatest("k_id", "k_id2").alias("a"), F.least("k_id", "k_id2").alias("b")).distinct()
    )
    done = tried.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    rest = staged(crossing.join(done, ["a", "b"], "left_anti"), "ngram-crossing")
    drop(left, tried, leads)
    if rest.limit(1).count():
        more = verified(rest)
        if more.limit(1).count():
            known = staged(connected_components(links.union(more)), "ngram-components")
        drop(more)
    drop(rest, links)
    return _labelled(sets, names, known, id_col)


def _labelled(sets: DataFrame, names: DataFrame, known: DataFrame, id_col: str) -> DataFrame:
    labels = names.join(known.withColumnRenamed("id", "node"), "node", "left").select(
        "s1", "s2", "n", F.coalesce("component", "node").alias("component_id")
    )
    joined = sets.join(staged(labels, "ngram-labels"), ["s1", "s2", "n"], "left")
    return joined.select(
        F.col("k_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("k_id").isNotNull(), F.coalesce("component_id", "k_id")).alias("component_id"),
        F.col("k_sig").alias("text_hash"),
    )


_KEPT_ID, _KEPT_HASH = "__tagloom_kept_id", "__tagloom_kept_hash"


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without near duplicates: of each component the document with the smallest id stays.

    Documents without words and rows without an id stay. Of rows that repeat the id that
    stays, the one with the smallest text hash does (of equal texts, the first one as JSON text).
    An empty table stays empty. All columns are kept as they are, whatever their names and types.
    """
    placed = staged(jaccard_components(docs, id_col, text_col, n, percent), "ngram-placed")
    same = placed.where(F.col(id_col) == F.col("component_id"))
    kept = staged(same.groupBy(F.col(id_col).alias(_KEPT_ID)).agg(F.min("text_hash").alias(_KEPT_HASH), F.count("*").alias("kept_rows")), "ngram-kept")
    key, text_hash = F.col(f"`{id_col}`"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    stay = docs.join(kept.hint("shuffle_hash"), (key == F.col(_KEPT_ID)) & (text_hash == F.col(_KEPT_HASH)), "left_semi")
    if kept.where("kept_rows > 1").limit(1).count():  # repeated ids: the same rows, one of each
        row = F.struct(*columns)
        stay = stay.groupBy(key.alias(_KEPT_ID)).agg(F.min_by(row, F.to_json(row)).alias("row")).select("row.*")
    return stay.select(*columns).union(docs.where(key.isNull()).select(*columns))

