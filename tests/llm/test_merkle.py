import hashlib

import pytest
from pyspark.sql import functions as F

from tagloom.llm.merkle import folded, manifest, proof_text, record_digest

DDL = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, place int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(digests, arity):
    """Root, and for each leaf its siblings on the way up."""
    proofs, nodes = [""] * len(digests), [(d, [i]) for i, d in enumerate(digests)]
    while len(nodes) > 1:
        above = []
        for at in range(0, len(nodes), arity):
            run = nodes[at : at + arity]
            for i, (_, below) in enumerate(run):
                for leaf in below:
                    proofs[leaf] += "".join(d for j, (d, _) in enumerate(run) if j != i)
            above.append((sha(*(d for d, _ in run)), [leaf for _, below in run for leaf in below]))
        nodes = above
    return nodes[0][0], proofs


def by_hand(rows, arity):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row[:5]), row[0]))
    made = []
    for group in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        leaves = sorted(groups[group], key=lambda x: x[:3])
        made.append((group, leaves, *tree([x[2] for x in leaves], arity)))
    root, upper = tree([m[2] for m in made], arity)
    return [
        (leaf[3], group, place, leaf[2], subroot, root, own + above)
        for (group, leaves, subroot, proofs), above in zip(made, upper)
        for place, (leaf, own) in enumerate(zip(leaves, proofs))
    ]


def key(row):
    return tuple("" if v is None else str(v) for v in row)


ROWS = (
    [(i, "hot" if i % 2 else f"s{i % 5}", "en", i, f"text {i}", "clash", 3) for i in range(200)]
    + [(7, "s2", None, 1, "é" * 3000, "", 0)] * 3
    + [(None, None, None, None, None, None, None), (None, "hot", None, None, "", None, None), (9, "alone", "", 0, "", "", 1), (4, None, "x", 1, "y", "", 1)]
)


@pytest.mark.parametrize(("arity", "height"), [(3, 6), (3, 1), (2, 2)])
def test_trees_by_hand(spark, arity, height):
    """Blocks of 729, 3 and 4 leaves give the same trees; one source holds half of the rows, three rows are equal."""
    got = manifest(spark.createDataFrame(ROWS, DDL), arity=arity, height=height)
    got = got.select("doc_id", "tree", "place", "leaf", "subroot", "root", proof_text(F.col("proof")).alias("p"), folded(F.col("leaf"), F.col("proof")).alias("back"), "claim").collect()
    assert all(r.back == r.root and r.claim is None for r in got)
    assert sorted((tuple(r[:7]) for r in got), key=key) == sorted(by_hand(ROWS, arity), key=key)


def test_claims(spark):
    rows = [(i, "a", "en", 3, "a\nb" if i % 2 else "ab", "", 0) for i in range(20)]
    changed = {"text": F.replace("text", F.lit("\n"), F.lit(""))}
    got = manifest(spark.createDataFrame(rows, DDL), claimed=changed).withColumn("ok", folded(F.coalesce("claim", "leaf"), F.col("proof")) == F.col("root"))
    assert {r.doc_id: r.ok for r in got.collect()} == {i: i % 2 == 0 for i in range(20)}


def test_small_tables(spark):
    df = spark.createDataFrame([(1, None, None, None, None, None, None)], DDL)
    assert manifest(df.limit(0)).collect() == []
    (row,) = manifest(df).collect()
    assert row.leaf == row.subroot == row.root == sha("1:1----") and row.proof == []
    with pytest.raises(ValueError):
        manifest(df, arity=1)


def test_record_digest_keeps_values_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "-"), ("-", None), ("", "")], "x string, y string")
    assert df.select(record_digest([F.col("x"), F.col("y")]).alias("d")).distinct().count() == 5


def test_plan_has_no_python(spark):
    plan = manifest(spark.createDataFrame(ROWS[:5], DDL))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
