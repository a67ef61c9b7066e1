"""Exact top-k inner products by no-random-access aggregation of sorted lists.

Each component of the candidate vectors is a list sorted by value, read from the top for
queries that weigh it positively and from the bottom for others. Lists are read in steps;
what was read of a candidate adds up to the known part of its score. A component not read yet
is worth at most the value at the reading position and at least the list's last value, so
every candidate, seen or not, has an upper and a lower bound. A query stops reading when
few outsiders are left whose upper bound reaches the k-th best lower bound; it resolves
the scores of those, and computes no other. Vectors without structure are read nearly to the
end before that happens: bounds of many components are loose.

The queries of a block read the same lists, each to its own depth, so a step is matrix
products over the entries that it reads. Scores already resolved carry over from one block
of candidates to the next as lower bounds.

Spark deals every pair of a query block and a candidate block to a task; each task sends
at most k rows per query, which a ranking per query merges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tagloom.llm.shipping import ship

_STEPS = (0.5, 0.75, 0.875, 0.9375, 0.96875, 1.0)  # parts of the lists read before checking the bounds
_RESOLVE = 0.02  # part of the candidates that may be left for resolving one by one
_ROWS = 4096  # candidates whose lists are read together


def _number_type(a: np.ndarray, b: np.ndarray) -> type:
    """A type in which sums of products are exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else object


class _Best:
    """The best k so far of each query, better first; ids break ties."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.rows = np.zeros(0, np.int64)
        self.scores, self.ids = np.zeros(0, object), np.zeros(0, np.int64)
        self.full = np.full(queries, -np.inf)  # k-th score, -inf while there are fewer

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        rows = np.concatenate((self.rows, rows))
        scores = scores if not len(self.scores) else np.concatenate((self.scores, scores))
        ids = np.concatenate((self.ids, ids)) if len(self.ids) else ids
        order = np.argsort(ids, kind="stable")
        order = order[np.argsort(-scores[order], kind="stable")]
        order = order[np.argsort(rows[order], kind="stable")]
        rows, scores, ids = rows[order], scores[order], ids[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        keep = place < self.k
        last = place == self.k - 1
        self.full[rows[last]] = scores[last].astype(float)
        self.rows, self.scores, self.ids = rows[keep], scores[keep], ids[keep]


def nearest(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, trace: list | None = None):
    """(query row, score, id) of each query's k best vectors; vectors with the query's own id are not candidates.

    ``trace`` takes, for each block of candidates, the depth to which each query read the
    lists and the number of scores it resolved.
    """
    order = np.argsort(ids, kind="stable")
    vectors, ids = vectors[order], ids[order]
    kind = _number_type(queries, vectors)
    best = _Best(len(queries), k)
    q = queries.astype(kind)
    for low in range(0, len(ids), _ROWS):
        block, names = vectors[low : low + _ROWS].astype(kind), ids[low : low + _ROWS]
        rows, cols, depths = _survivors(q, block, _own(query_ids, names), best.full, k)
        scores = _pairs(q, block, rows, cols)
        if trace is not None:
            trace.append((depths, np.bincount(rows, minlength=len(q))))
        # Ids ascend from block to block, so a tie with earlier scores loses.
        better = np.array([score > best.full[row] for row, score in zip(rows, scores)], bool) if kind is object else scores > best.full[rows]
        best.add(rows[better], scores[better], names[cols[better]])
    return best.rows, best.scores, best.ids


def _survivors(q: np.ndarray, block: np.ndarray, own: tuple[np.ndarray, np.ndarray], full: np.ndarray, k: int):
    """(query row, candidate) of the pairs whose scores are to be resolved, and the depth each query read to.

    ``full`` is the k-th score that each query has already.
    """
    n, lists = len(block), np.sort(block, axis=0)
    sides = np.concatenate((np.maximum(q, 0), np.minimum(q, 0)), axis=1)
    both, last = np.concatenate((block, block), axis=1), np.concatenate((lists[0], lists[-1]))
    barred = np.zeros((len(q), n), bool)
    barred[own] = True
    reading, depths = np.arange(len(q)), np.zeros(len(q))
    known, read = np.zeros((len(q), n), q.dtype), np.zeros(both.shape, bool)
    rows, cols = [], []
    for part in _STEPS if q.dtype != object else _STEPS[-1:]:
        depth = max(1, int(n * part))
        at = np.concatenate((lists[n - depth], lists[depth - 1]))
        reached = np.concatenate((block >= at[: block.shape[1]], block <= at[block.shape[1] :]), axis=1)
        known += sides @ np.where(reached & ~read, both, 0).T
        read = reached
        unread = (~read).astype(q.dtype)
        upper, lower = known + (sides * at) @ unread.T, known + (sides * last) @ unread.T
        lower[barred] = -np.inf
        alive = (upper > full[reading][:, None]) & ~barred
        if n > k:
            alive &= upper >= np.partition(lower, n - k, axis=1)[:, n - k][:, None]
        stop = np.count_nonzero(alive, axis=1) <= max(2 * k, _RESOLVE * n)
        stop |= part == _STEPS[-1]
        found, which = np.nonzero(alive & stop[:, None])
        rows.append(reading[found])
        cols.append(which)
        depths[reading[stop]] = part
        reading, known, sides, barred = reading[~stop], known[~stop], sides[~stop], barred[~stop]
        if not len(reading):
            break
    return np.concatenate(rows), np.concatenate(cols), depths


def _pairs(q: np.ndarray, block: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Scores of single pairs, in bounded pieces."""
    out = np.empty(len(rows), q.dtype)
    for low in range(0, len(rows), 1 << 16):
        part = slice(low, low + (1 << 16))
        out[part] = (q[rows[part]] * block[cols[part]]).sum(axis=1)
    return out


def _own(query_ids: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a candidate with its id; ``names`` ascend."""
    first, last = np.searchsorted(names, query_ids), np.searchsorted(names, query_ids, "right")
    counts = last - first
    rows = np.repeat(np.arange(len(query_ids)), counts)
    return rows, np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts - first, counts)


def _whole(column: pa.ChunkedArray, size: int, scale: float) -> np.ndarray:
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    values = np.floor(scale * values).reshape(len(column), size)
    if np.abs(values).max(initial=0) >= 2**53:
        return np.array([[int(x) for x in row] for row in values.tolist()], object).reshape(len(column), size)
    return values


def _task(k: int, scale: float, schema: pa.Schema):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        size = left["size"][0].as_py()
        rows, scores, ids = nearest(
            _whole(left["vec"], size, scale), left["id"].to_numpy(), _whole(right["vec"], size, scale), right["id"].to_numpy(), k
        )
        clipped = [max(-(2**63), min(2**63 - 1, int(x))) for x in scores.tolist()]
        take = pa.array(rows)
        return pa.Table.from_arrays(
            [left["id"].combine_chunks().take(take), left["mark"].combine_chunks().take(take), pa.array(ids, schema.field("vec_id").type), pa.array(clipped, pa.int64())],
            schema=schema,
        )

    return run


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 64.0,
    query_block: int = 1024, candidate_block: int = 65536,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query, ties to the smaller id.

    Components become floor(scale * x); the score is the integer inner product. Candidates are
    all vectors but those with the query's own id. Block sizes only group the work; candidate
    blocks are smaller where there would be too few for the cluster.

    - Null ids, null vectors, and vectors with null, NaN or infinite components take no part.
    - A query meets vectors of its own length only. Vectors of length 0 score 0.
    - A query repeated with the same vector is one query, as both would have the same rows;
      with another vector it is a second one. Repeated candidates each take a rank.
      Very long vectors are read whole; a task holds a block of each side, so blocks are to be
      smaller for them. Fewer than k candidates: all of them.
    - Scores beyond 64 bits are shown as the nearest 64-bit number. An empty table gives no
      rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    vec = F.col(f"`{vec_col}`")
    ordinary = vec.isNotNull() & ~F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    plain = vectors.where(F.col(f"`{id_col}`").isNotNull() & F.coalesce(ordinary, F.lit(False)))
    shown = [F.col(f"`{id_col}`").alias("id"), vec.alias("vec"), F.size(vec).alias("size")]
    candidates = plain.select(*shown)
    queries = plain.where(is_query).select(*shown).withColumn("mark", F.xxhash64("vec")).dropDuplicates(["id", "mark"])
    n, n_queries = candidates.count(), queries.count()
    query_groups = max(1, -(-n_queries // query_block))
    wanted = -(-2 * spark.sparkContext.defaultParallelism // query_groups)  # groups that keep all cores busy
    groups = max(1, -(-n // candidate_block), min(wanted, n // _ROWS))
    # Rows are dealt by their place in the input, so equal vectors spread evenly.
    dealt = candidates.withColumn("c_group", F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int"))
    dealt = dealt.withColumn("q_group", F.explode(F.sequence(F.lit(0), F.lit(query_groups - 1))))
    asked = queries.withColumn("q_group", F.pmod(F.xxhash64("id", "mark"), F.lit(query_groups)).cast("int"))
    asked = asked.withColumn("c_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    kind = candidates.schema["id"].dataType
    schema = pa.schema([("query_id", to_arrow_type(kind)), ("mark", pa.int64()), ("vec_id", to_arrow_type(kind)), ("score", pa.int64())])
    keys = ["size", "q_group", "c_group"]
    name = kind.simpleString()
    partial = asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(
        _task(k, scale, schema), f"query_id {name}, mark long, vec_id {name}, score long"
    )
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
