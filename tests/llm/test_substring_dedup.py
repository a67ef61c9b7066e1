import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tagloom.llm.substring_dedup import _sliding, repeated_passages_removed

DDL = "doc_id bigint, text string, n_words int, removed string"


def brute(rows, length):
    split = [(i, [w for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w]) for i, t in rows]
    counts = Counter(tuple(w[k : k + length]) for _, w in split for k in range(len(w) - length + 1))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if counts[tuple(w[k : k + length])] > 1:
                gone[k : k + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


def found(spark, rows, length, anchor):
    df = spark.createDataFrame([(i, t, 1, "clash") for i, t in rows], DDL)
    got = repeated_passages_removed(df, length=length, anchor=anchor)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got.collect()), key=str)


@pytest.mark.parametrize("length, anchor", [(35, 8), (6, 2), (5, 5)])
def test_equals_brute_force(spark, length, anchor):
    rng = random.Random(length)
    word = lambda: f"w{rng.randrange(10**6)}"
    shared = [[word() for _ in range(length + k)] for k in (-1, 0, 1, 20)]
    rows = []
    for i in range(40):
        words = [word() for _ in range(rng.randrange(2 * length))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = rng.choice(shared)
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(words)))
    loop = " ".join(["again and"] * length)  # repeats itself within one text
    rows += [(50, loop), (51, None), (52, ""), (None, rows[3][1] + " é"), (53, " ".join(shared[3])), (54, " ".join(shared[3])), (54, " ".join(shared[3])), (55, " ".join(shared[0])), (55, " ".join(shared[0]))]
    assert found(spark, rows, length, anchor) == brute(rows, length)


def test_large_group_of_copies_and_a_partial_one(spark):
    text = " ".join(f"t{i}" for i in range(120))
    rows = [(i, text) for i in range(50)] + [(99, "x y " + " ".join(f"t{i}" for i in range(40, 90)) + " z")]
    assert found(spark, rows, 35, 8) == brute(rows, 35)


def test_intervals_are_maximal(spark):
    a = " ".join(f"a{i}" for i in range(60))
    df = spark.createDataFrame([(1, "p q " + a + " r"), (2, a + " s")], "doc_id int, text string")
    got = {r.doc_id: (r.removed, r.kept) for r in repeated_passages_removed(df).collect()}
    assert got == {1: ([2, 62], "p q r"), 2: ([0, 60], "s")}
    assert repeated_passages_removed(df.limit(0)).collect() == []


def test_sliding():
    values = np.random.default_rng(0).integers(0, 99, 200).astype(np.uint64)
    for width in (1, 2, 7, 28):
        assert _sliding(values, width, np.minimum).tolist() == [values[i : i + width].min() for i in range(200 - width + 1)]
