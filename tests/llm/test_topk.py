import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.llm import topk
from tagloom.llm.topk import nearest, top_k


def brute(rows, k, scale=64):
    whole = {}
    for place, (i, v) in enumerate(rows):
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole[place] = (i, [math.floor(scale * float(np.float32(x))) for x in v])
    asked = {(i, tuple(v)) for i, v in whole.values() if i % 5 == 0}
    out = []
    for i, v in asked:
        found = [(-sum(a * b for a, b in zip(v, w)), j) for j, w in whole.values() if j != i and len(w) == len(v)]
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def found(spark, rows, k=4, **more):
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id bigint, embedding array<float>, score int, rank int")
    return sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 5 == 0, k=k, **more).collect())


def test_equals_brute_force_with_ties_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.1, 6)]) for i in range(80)]
    rows += [(100 + i, [0.25] * 6) for i in range(30)]  # one very common vector
    rows += [(7, rows[7][1]), (200, None), (205, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (210, [float("nan")] * 6), (215, [float("inf")] * 6), (None, [0.1] * 6), (220, [0.5, 0.5]), (221, [0.5, -0.5]), (225, [])]
    expected = brute(rows, 4)
    assert found(spark, rows) == expected
    assert found(spark, rows, query_block=5, candidate_block=16) == expected


def test_fewer_than_k_and_empty(spark):
    assert found(spark, [(5, [1.0, 0.0]), (6, [0.5, 0.0])], k=9) == [(5, 1, 6, 64 * 32)]
    assert found(spark, []) == []


@pytest.mark.parametrize("spread", [1, 50, 10**6, 10**17])
def test_bounds_are_exact_at_any_size_of_numbers(spread, monkeypatch):
    monkeypatch.setattr(topk, "_ROWS", 64)
    rng = np.random.default_rng(spread)
    vectors = rng.integers(-spread, spread + 1, (400, 8))
    vectors = vectors.astype(object) if spread > 2**53 else vectors.astype(np.float64)
    ids = rng.permutation(400)
    rows, scores, names = nearest(vectors[:20], ids[:20], vectors, ids, 7)
    for q in range(20):
        exact = sorted((-sum(int(a) * int(b) for a, b in zip(vectors[q], v)), int(i)) for v, i in zip(vectors, ids) if i != ids[q])[:7]
        assert sorted((-int(s), int(n)) for r, s, n in zip(rows, scores, names) if r == q) == exact


def test_reading_stops_early(monkeypatch):
    resolved = []
    pairs = topk._pairs
    monkeypatch.setattr(topk, "_pairs", lambda q, b, rows, cols: (resolved.append(len(rows)), pairs(q, b, rows, cols))[1])
    rng = np.random.default_rng(0)
    vectors = np.floor(64 * rng.normal(0, 0.125, (20_000, 64)))
    nearest(vectors[:50], np.arange(50), vectors, np.arange(20_000), 20)
    assert resolved and sum(resolved) < 0.02 * 50 * 20_000


def test_depths_on_the_given_table(spark):
    """No score but the survivors' is computed, a few in a hundred; nothing is read beyond what the bounds ask for."""
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    vectors, ids = np.floor(64.0 * np.array([r.embedding for r in rows], np.float64)), np.array([r.vec_id for r in rows])
    asked, trace = ids % 20 == 0, []
    got = nearest(vectors[asked], ids[asked], vectors, ids, 20, trace)
    exact = vectors[asked] @ vectors.T
    exact[ids[asked][:, None] == ids[None, :]] = -np.inf
    for q in range(int(asked.sum())):
        order = sorted(range(len(ids)), key=lambda j: (-exact[q, j], ids[j]))[:20]
        assert sorted(zip(-got[1][got[0] == q], got[2][got[0] == q])) == [(-exact[q, j], ids[j]) for j in order]
    ((depths, resolved),) = trace
    assert resolved.sum() <= 0.03 * asked.sum() * len(ids) and set(depths) <= set(topk._STEPS)
    print("depths", dict(zip(*np.unique(depths, return_counts=True))), "resolved", resolved.sum() / (asked.sum() * len(ids)))


def test_near_vectors_stop_the_reading_early():
    """Clusters: a query's own cluster stands out, so half of the lists is enough."""
    rng, trace = np.random.default_rng(2), []
    centres = rng.normal(0, 1, (100, 16))
    vectors = np.floor(64 * (np.repeat(centres, 40, axis=0) + rng.normal(0, 0.02, (4000, 16))))
    nearest(vectors[::40], np.arange(0, 4000, 40), vectors, np.arange(4000), 20, trace)
    assert np.mean(trace[0][0] < 1) == 1 and trace[0][1].max() <= 80
