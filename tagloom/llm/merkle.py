"""A Merkle manifest of a table: digests by which any row can be proven to belong to it.

Each group of rows (a source) is a tree over its rows in order, and the groups' roots are
the leaves of one more tree. Nothing holds a whole group: its leaves are cut into aligned
blocks of ``arity ** height``, and a block keeps each of its levels as one string of hex
digests put end to end. The parents of a level are the digests of its substrings of
``arity`` digests' width, and the siblings of a node are the substrings on its two sides
within its parent's. The roots of a group's blocks are the leaves of the next round, which
is that much smaller, until one block holds what is left. Proofs are put together the other
way: each round adds the siblings inside its blocks to those of the blocks above.

Places come from a range partitioning: rows are counted per partition and group, and each
partition's rows move up by those before them, so that a group may lie in any number of
partitions and rows that are equal in everything may too.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import drop, staged

_HEX = 64  # characters of a digest
_STEP = "array<struct<left:string,right:string>>"


def record_digest(columns: Sequence[Column]) -> Column:
    """Hex SHA-256 of values put end to end: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    texts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def folded(digest: Column, proof: Column) -> Column:
    """The root that follows from a leaf's digest and the siblings on its way up."""
    return F.aggregate(proof, digest, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def proof_text(proof: Column) -> Column:
    """All siblings of a proof put end to end."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "source",
    claimed: Mapping[str, Column] | None = None,
    arity: int = 3,
    height: int = 6,
) -> DataFrame:
    """One row per input row: id, group, place, leaf, claim, subroot, root, proof.

    ``leaf`` is the :func:`record_digest` of ``fields``. The leaves of a group ascend by id
    (``place`` counts from 0), and each ``arity`` neighbours have the digest of their digests
    as parent (the last ones may be fewer, even one) until one node is left, the ``subroot``.
    Subroots ascend by group (as text) and make ``root`` likewise. ``proof`` lists, from the
    leaf up to the root, the siblings to the left and right as text: see :func:`folded`.
    ``claim`` is the digest of the row with ``claimed`` values in place of its own, null
    where that is the same; whether the table holds the row as claimed is whether the claim
    folds to the root.

    - Null group: a group of its own, first of all. Null ids come first in their group.
    - Repeated ids ascend by leaf; rows equal in all fields have equal leaves and
      neighbouring places, and which of them has which is fixed once the leaves are written.
    - Empty table: no rows. Columns other than the fields are not read.
    - Very long texts are hashed where they are read; only digests are shuffled.
    """
    if arity < 2 or height < 1:
        raise ValueError("a tree needs an arity of 2 or more and a height of 1 or more")
    stored = {name: F.col(f"`{name}`") for name in dict.fromkeys((*fields, id_col, group_col))}
    leaf = record_digest([stored[name] for name in fields])
    claim = record_digest([(claimed or {}).get(name, stored[name]) for name in fields]) if claimed else leaf
    rows = docs.select(
        stored[id_col].alias("k_id"), stored[group_col].cast("string").alias("k_group"), leaf.alias("digest"), claim.alias("claim")
    )
    # The number of a row, kept with it, tells equal rows apart in every attempt of a task.
    rows = rows.withColumn("claim", F.nullif("claim", "digest")).withColumn("number", F.monotonically_increasing_id())
    leaves = staged(rows, "merkle-leaves")
    placed, ranged = _placed(leaves, ["k_id", "digest", "number"])
    rounds, subroots = _tree(placed, arity, height)
    drop(leaves, ranged)
    # The groups are the leaves of the tree above, all in one group.
    groups = subroots.select(F.col("k_group").alias("k_id"), F.lit("").alias("k_group"), "digest", F.lit(None).cast("string").alias("claim"))
    placed, ranged = _placed(groups, ["k_id"])
    upper, roots = _tree(placed, arity, height)
    drop(ranged)
    top = roots.select("k_group", F.col("round"), F.col("digest").alias("subroot"), F.col("digest").alias("root"), F.array().cast(_STEP).alias("proof"))
    proven = _proofs(upper, top, arity, height).select(F.col("k_id").alias("p_group"), "root", "proof")
    above = subroots.join(proven, F.col("k_group").eqNullSafe(F.col("p_group"))).select(
        "k_group", "round", F.col("digest").alias("subroot"), "root", "proof"
    )
    found = _proofs(rounds, staged(above, "merkle-groups"), arity, height)
    return found.select(F.col("k_id").alias(id_col), F.col("k_group").alias("tree"), "place", F.col("digest").alias("leaf"), "claim", "subroot", "root", "proof")


def _placed(nodes: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``nodes`` with ``place`` within its group, counted from 0, and ``total``, the group's size;
    and the staged table they are read from."""
    spark = nodes.sparkSession
    by = ["k_group", *order]
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The number a row gets after sorting holds its partition and its place there.
    ranged = nodes.repartitionByRange(partitions, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    ranged = staged(ranged.withColumn("part", F.shiftright("at", 33)), "merkle-ranged")
    counts = ranged.groupBy("k_group", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    group = Window.partitionBy("k_group")
    before = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each partition and each group that it holds; a partition holds some groups whole and parts of two.
    offsets = counts.select(
        F.col("k_group").alias("o_group"), F.col("part").alias("o_part"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(group).alias("total"),
    )
    same = F.col("k_group").eqNullSafe(F.col("o_group")) & (F.col("part") == F.col("o_part"))
    placed = ranged.join(offsets, same)
    return placed.select("k_group", "k_id", "digest", "claim", (F.col("at") + F.col("shift")).alias("place"), "total"), ranged


def _parents(level: str, arity: int) -> str:
    """SQL of the level above one: digests of its substrings of ``arity`` digests' width."""
    run = _HEX * arity
    # As bytes a substring is found without counting characters; the one-element array converts once.
    parents = f"transform(sequence(0, (length(b) - 1) div {run}), i -> sha2(substring(b, int(i) * {run} + 1, {run}), 256))"
    return f"transform(array(CAST({level} AS BINARY)), b -> array_join({parents}, ''))[0]"


def _lifts(arity: int, height: int) -> str:
    """SQL of how many levels a block is lifted: to its root, where it holds all of its group."""
    cases = "".join(f"WHEN total <= {arity**h} THEN {h} " for h in range(height))
    return f"CASE {cases}ELSE {height} END"


def _tree(placed: DataFrame, arity: int, height: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round, and (k_group, digest, round): each group's root and the round that made it."""
    width, rounds, done = arity**height, [], []
    nodes = placed
    while True:
        held = nodes.groupBy("k_group", F.expr(f"place div {width}").alias("block")).agg(
            F.first("total").alias("total"), F.sort_array(F.collect_list(F.struct("place", "digest", "k_id", "claim"))).alias("nodes")
        )
        lifted = held.withColumn("base", F.expr("array_join(transform(nodes, x -> x.digest), '')")).withColumn("lifts", F.expr(_lifts(arity, height)))
        levels = f"aggregate(sequence(0, lifts), CAST(array() AS array<string>), (up, j) -> concat(up, array(CASE WHEN j = 0 THEN base ELSE {_parents('element_at(up, -1)', arity)} END)))"
        blocks = staged(
            lifted.select(
                "k_group", "block", "total", F.expr(levels).alias("levels"),
                F.expr("transform(nodes, x -> named_struct('k_id', x.k_id, 'claim', x.claim))").alias("nodes"),
            ),
            "merkle-blocks",
        )
        number = len(rounds)
        rounds.append(blocks)
        roots = blocks.select("k_group", "block", "total", F.element_at("levels", -1).alias("digest"))
        done.append(roots.where(f"total <= {width}").select("k_group", "digest", F.lit(number).alias("round")))
        rest = roots.where(f"total > {width}")
        if rest.isEmpty():
            break
        nodes = rest.select(
            "k_group", F.lit(None).cast(placed.schema["k_id"].dataType).alias("k_id"), "digest", F.lit(None).cast("string").alias("claim"),
            F.col("block").alias("place"), F.expr(f"(total + {width - 1}) div {width}").alias("total"),
        )
    subroots = done[0]
    for more in done[1:]:
        subroots = subroots.union(more)
    return rounds, subroots


def _proofs(rounds: list[DataFrame], groups: DataFrame, arity: int, height: int) -> DataFrame:
    """The leaves of a tree with ``groups``' subroot and root, and the siblings up to the root.

    ``groups`` has (k_group, round, subroot, root, proof): the proof of a group's own root.
    """
    width = arity**height
    powers = f"array({', '.join(str(arity**h) for h in range(height))})"
    node = f"(p div {powers}[j])"
    siblings = f"""transform(slice(bytes, 1, size(bytes) - 1), (b, j) -> named_struct(
        'left', string(substring(b, int(({node} - {node} % {arity}) * {_HEX} + 1), int({node} % {arity} * {_HEX}))),
        'right', string(substring(b, int(({node} + 1) * {_HEX} + 1), int(({arity - 1} - {node} % {arity}) * {_HEX})))))"""
    each = f"""transform(array(transform(levels, l -> CAST(l AS BINARY))), bytes -> transform(nodes, (x, p) -> named_struct(
        'k_id', x.k_id, 'claim', x.claim, 'place', block * {width} + p,
        'digest', string(substring(bytes[0], p * {_HEX} + 1, {_HEX})), 'proof', concat({siblings}, proof))))[0]"""
    below: DataFrame | None = None
    for number in range(len(rounds) - 1, -1, -1):
        own = groups.where(F.col("round") == number).select(F.col("k_group").alias("a_group"), F.lit(0).cast("long").alias("a_block"), "subroot", "root", "proof")
        if below is not None:
            own = own.union(below.select("k_group", "place", "subroot", "root", "proof"))
        same = F.col("k_group").eqNullSafe(F.col("a_group")) & (F.col("block") == F.col("a_block"))
        joined = rounds[number].join(own, same)
        below = joined.select("k_group", "subroot", "root", F.explode(F.expr(each)).alias("x")).select("k_group", "subroot", "root", "x.*")
    return below
