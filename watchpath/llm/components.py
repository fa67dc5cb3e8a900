"""Connected components of a distributed edge list.

Alternating large-star and small-star steps: every step points a node's larger
neighbours (then its smaller ones) at the least node it sees, until the edges
form stars around each component's least node. A step is an aggregation and a
join, both of which Spark spreads for a hot node (partial aggregation; split
join partitions). Each step is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import materialize


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is joined to the least of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both).select("a", F.least("a", "least").alias("least"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from larger to smaller; smaller neighbours and the node itself are joined to the least."""
    least = _least(edges)
    rest = edges.join(least, "a").filter("b > least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return rest.union(least.select("a", F.col("least").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b): node, component (the least node of its component).

    Nodes without an edge to another node do not appear; nulls are no nodes.
    """
    stars = edges.filter("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    stars, n = materialize(stars, "components", count=True)
    before = None
    while n:
        stars = materialize(_small_star(_large_star(stars)), "components")
        after = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    centres = stars.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(centres)
