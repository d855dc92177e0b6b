"""Connected components of a graph that Spark holds, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livetables.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node goes to the smallest of the node's neighbourhood."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy(F.col("a").alias("n")).agg(F.min(F.least("a", "b")).alias("m"))
    # at most a row for each edge and end; what repeats goes with the small star's
    moved = both.join(least, both["a"] == least["n"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them; edges are (larger, smaller)."""
    least = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    moved = edges.join(least, edges["a"] == least["n"]).select(F.col("b").alias("x"), F.col("m").alias("b"))
    return (moved.union(least.select("n", "m")).where("x <> b").select(F.col("x").alias("a"), "b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _settled(edges: DataFrame) -> bool:
    """Whether every edge (larger, smaller) points from a node to its root: one for each node, none from a root."""
    ends = edges.select(F.col("a").alias("n"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("n"), F.col("b").alias("root")))
    return ends.groupBy("n").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> (node, root): each node that has a link, with the smallest node it is connected to.

    The steps only aggregate by minimum and join, so a node with very many links
    is split by AQE; their number grows with the logarithm of the graph's width.
    Links are read several times, so they should be `written`.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    while not _settled(edges):
        edges = written(_small_star(_large_star(edges)), "links")
    # settled: every edge points from a node to its root
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
