"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b): each node's larger (or smaller) neighbours are hung on its least neighbour.

    The least neighbour is a partial aggregate, and the join back is one that Spark can split where a hub is hot.
    """
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        hung = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        joined = down.join(least, "a")
        hung = joined.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
    return hung.filter("a != b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """For each node with an edge: (node, root), root the least node that it reaches. Rounds grow with the logarithm of the nodes."""
    edges = saved(edges.select("a", "b").filter("a != b").distinct())
    before = None
    while True:
        edges = saved(_stars(_stars(edges, True), False))
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
