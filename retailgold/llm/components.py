"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailgold.llm.frames import stored


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node either has one smaller neighbour and no larger one, or only larger ones."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Large star: a node's larger neighbours go to its smallest.  Small star: it and its smaller ones do.

    The smallest neighbour comes from a partial aggregate; the join back may split a node with very many neighbours.
    """
    if larger:
        edges = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    if larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b"))
    else:
        out = joined.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every linked node: the smallest node it can reach.  ``edges`` has columns a, b; nulls link nothing.

    Each round goes to the shared folder.  Edges always lead to the smaller node, so when they are stars their centers are the
    smallest nodes.  The driver sees one answer per round; rounds grow with the logarithm of the longest chain.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = stored(edges, "links")
    while not _are_stars(edges):
        edges = stored(_star(_star(edges, True), False), "links")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select("component", "component").distinct())
