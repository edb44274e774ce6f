"""Connected components of a graph given as rows, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .shared import settled


def components(links: DataFrame) -> DataFrame:
    """(node, component: the smallest node reachable) of the nodes in links(a, b).

    Each step joins on a node's smallest neighbour, which is pre-aggregated in the map tasks; a hub's many links are
    dealt anew by adaptive skew joins.  The number of steps grows with the logarithm of a component's size; they go on
    until one changes nothing.
    """
    edges = settled(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")), F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("e"))
        edges = settled(small.select(F.col("e.x").alias("a"), F.col("e.y").alias("b")).where("a != b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component").union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        before = now
