"""Connected components by alternating star operations, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import drop, staged


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (two columns): the smallest id reachable.

    Large-star links each neighbour above a node to the smallest of its surroundings,
    small-star those below; edges never outnumber the links given, and a logarithmic number
    of rounds leaves one star per component. Each round is written below
    ``spark.checkpoint.dir``, so a lost executor costs part of one round. Minima are
    combined before the shuffle and joined back as an own table, so that adaptive execution
    can split the rows of a hub. Null ends and links of an id with itself are passed over.
    """
    a, b = links.columns
    met = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    edges = staged(met.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "star")
    before = _digest(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = staged(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "star-low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u > v").distinct(), "star-large")
        drop(low)
        low = staged(large.groupBy("u").agg(F.min("v").alias("m")), "star-low")
        joined = large.join(low, "u")
        old = edges
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = staged(small.where("u > v").distinct(), "star")
        drop(old, low, large)
        after = _digest(edges)
        if after == before:
            break
        before = after
    # What is left is one star per component.
    roots = edges.select(F.col("v").alias("id")).distinct().withColumn("component", F.col("id"))
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.hash("u", "v")), F.sum(F.hash("v", F.lit(7), "u"))).first()
    return tuple(row)
