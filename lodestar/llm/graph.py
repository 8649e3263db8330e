"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import cut


def _all_stars(edges: DataFrame) -> bool:
    """Every edge leads to a root: no node has two edges out, or edges in and out."""
    one, none = F.lit(1), F.lit(0)
    ends = edges.select(F.col("u").alias("x"), one.alias("o"), none.alias("i")).union(
        edges.select(F.col("v").alias("x"), none.alias("o"), one.alias("i")))
    odd = ends.groupBy("x").agg(F.sum("o").alias("o"), F.max("i").alias("i")).where("o > 1 or (o > 0 and i > 0)")
    return not odd.take(1)


def components(links: DataFrame) -> DataFrame:
    """(a, b) links -> (node, root) for every linked node that is not the
    smallest of its component; the root is the smallest.

    Large-star joins every larger neighbour of a node to the node's smallest
    neighbour, small-star every smaller one; this ends when all edges lead to
    roots, which is tested first, after a number of rounds that grows with the logarithm of the size.
    Minima are aggregated map-side; edges are checkpointed each round."""
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while not _all_stars(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.first("u"), F.min("v")).alias("m")).withColumnRenamed("u", "key")
        large = (both.join(least, both["u"] == least["key"]).where("v > u and v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "key")
        small = (large.join(least, large["u"] == least["key"]).where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = cut(small.union(least.select(F.col("key").alias("u"), F.col("m").alias("v"))).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
