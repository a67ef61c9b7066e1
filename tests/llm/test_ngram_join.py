import random
import re

import pytest

from tagloom.llm.components import connected_components
from tagloom.llm.ngram_join import _too_far, jaccard_components, one_of_each_group

DDL = "doc_id bigint, text string, component_id int, n string"
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, n):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(FOLD)) if w]
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute(rows, n, percent):
    """Component of each id, by all pairs."""
    parent = {i: i for i, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(i, shingles(t, n)) for i, t in rows]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if None not in (i, j) and a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return sorted(((i, len(s), root(i) if i is not None else None) for i, s in sets), key=str)


def edited(words, rng, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**9)}"
    return " ".join(words)


def found(spark, rows, **more):
    df = spark.createDataFrame([(i, t, 7, "clash") for i, t in rows], DDL)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(df, **more).collect()), key=str)


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80)])
def test_equals_brute_force(spark, n, percent):
    rng = random.Random(n)
    base = [f"w{i}" for i in range(120)]
    rows = [(100 + i, edited(base, rng, i % 6)) for i in range(60)]  # near copies around the threshold
    passage = " ".join(f"p{i}" for i in range(40))
    rows += [(300 + i, passage + " " + " ".join(f"o{i}x{k}" for k in range(rng.randrange(60)))) for i in range(25)]
    rows += [(400 + i, "The  SAME\ttext of words") for i in range(12)] + [(420, "the same text of words"), (421, "same text")]
    rows += [(500, None), (501, ""), (502, " \n"), (None, "the same text of words"), (400, "The  SAME\ttext of words"), (400, passage)]
    rows += [(600, "one two"), (601, "ONE two"), (602, "one two three"), (603, "two one")]
    assert found(spark, rows, n=n, percent=percent) == brute(rows, n, percent)


def test_chain_of_links_is_one_component(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[7 * i : 7 * i + 100])) for i in range(30)]
    assert found(spark, rows) == brute(rows, 4, 85)
    assert {c for _, _, c in found(spark, rows)} == {0}


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], DDL)).collect() == []


def test_one_of_each_group_stays(spark):
    rows = [(5, "a b c d e f g", 1, "x"), (3, "A b c d e f g", 2, "y"), (9, None, 3, "z"), (None, "a b c d e f g", 4, "w"), (3, "A b c d e f g", 2, "y"), (8, "quite another text of many words", 5, "v")]
    got = one_of_each_group(spark.createDataFrame(rows, DDL))
    assert got.columns == ["doc_id", "text", "component_id", "n"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted([rows[1], rows[2], rows[3], rows[5]], key=str)


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7), (None, 3)]
    parent = {i: i for p in pairs for i in p if None not in p and p[0] != p[1]}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        if a is not None and a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    got = connected_components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()
    assert sorted(map(tuple, got)) == sorted((i, root(i)) for i in parent)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_suffix_filter_never_rejects_near_sets():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(300):
        x = np.unique(rng.integers(0, 400, 60).astype(np.uint64))
        y = np.unique(np.concatenate((x[rng.random(len(x)) < 0.8], rng.integers(0, 400, 12).astype(np.uint64))))
        apart = len(np.setxor1d(x, y))
        assert not _too_far(x, y, apart, 3)


def test_one_of_each_group_keeps_any_columns(spark):
    """Columns called like the operator's own, a map, and repeated rows of one id."""
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text, 7, 8, {"a": 1}), (1, text, 7, 8, {"a": 2}), (2, text + " end", 0, 0, None), (3, "else " * 3 + "where", 1, 1, {}), (None, text, 2, 2, None), (None, None, 3, 3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kept_id int, kept_hash int, m map<string,int>")
    got = one_of_each_group(docs)
    assert got.columns == docs.columns
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.kept_id)
    assert [tuple(r) for r in sorted(got.collect(), key=key)] == [rows[0], rows[3], rows[4], rows[5]]
    assert one_of_each_group(docs.limit(0)).collect() == []
