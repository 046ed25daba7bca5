"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewise.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Relink each node's neighbours (larger ones, or itself and smaller ones) to the smallest of them all.

    The smallest neighbour comes from a partial aggregate and is joined back,
    so a node with very many neighbours is never gathered in one place.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else both.where("b < a")
    least = near.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    moved = (near.where("b > a") if large else near).join(least, "a").select(F.col("least").alias("a"), "b")
    if not large:
        moved = moved.unionByName(least.select(F.col("least").alias("a"), F.col("a").alias("b")))
    return moved.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is either linked to one smaller node that has no smaller one, or to larger ones only."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("child")).unionByName(edges.select(F.col("b").alias("node"), F.lit(1).alias("child")))
    roles = ends.groupBy("node").agg(F.sum("child").alias("parents"), F.min("child").alias("least"))
    return roles.where("parents > 1 OR (parents = 1 AND least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of (a, b): the smallest node reachable. Self-links and repeats are harmless.

    Each round is stored; rounds grow with the logarithm of a component's
    length. Nulls must be left out by the caller.
    """
    start = stored(edges.select("a", "b"), "links")
    now = stored(start.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "stars")

    while not _all_stars(now):
        now = stored(_star(_star(now, large=True), large=False), "stars")
    nodes = start.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    found = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
