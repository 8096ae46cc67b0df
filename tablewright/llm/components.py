"""Connected components of large edge tables, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.session import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b): the least node it is connected to.

    Rounds of large-star and small-star steps: every node hands its larger neighbours the least
    node around it, then its smaller ones. Both are a windowless aggregation (least neighbour) and
    a join back, so a hub's edges stay spread; the number of rounds grows with the logarithm of
    the longest chain. Every round is a written table in the shared folder. Any ordered
    type serves as node; edges with a NULL end and loops are ignored; no edge gives no row.
    """
    def least(df: DataFrame) -> DataFrame:
        return df.groupBy("a").agg(F.min("b").alias("m"))

    both = edges.select("a", "b").where("a <> b")
    both = materialize(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        # Large star: the neighbours above a node, and the node itself, point to the least around it.
        twice = both.union(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = least(twice).select("a", F.least("a", "m").alias("m"))
        large = (twice.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.where("m < a").select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        large = materialize(large, "large-star")
        # Small star: the neighbours below a node, and the node itself, point to the least below it.
        low = least(large)
        small = (large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        small = materialize(small, "small-star")
        # Done when every node has one edge and no node pointed to has one.
        ends = small.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
            small.select(F.col("b"), F.lit(0), F.lit(1)))
        open_nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR (up = 1 AND down = 1)")
        both = small
        if open_nodes.isEmpty():
            break
    return both.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        both.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
