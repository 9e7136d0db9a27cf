"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.common import Tables


def _with_least(pairs: DataFrame) -> DataFrame:
    """Pairs (u, v) with the least of u and its v. The minimum is combined before the shuffle, so a hub's many pairs
    meet only as partial minima; the join back may be split by adaptive execution."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    return _with_least(both).filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    return (
        down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select("u", "m"))
    )


def _settled(edges: DataFrame) -> bool:
    """Whether every edge leads from a member straight to the least of its component: no node has two parents, and no
    parent has one."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("child")).union(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("child"))
    )
    seen = ends.groupBy("node").agg(F.sum("child").alias("parents"), F.min("child").alias("leaf"))
    return seen.filter("parents > 1 or (parents = 1 and leaf = 0)").isEmpty()


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """Map every node of ``edges`` (columns a, b, same type) to the least node of its component.

    Returns (node, component) for nodes that have an edge to another node; an edge of a node to itself is ignored,
    repeated edges count once, and no edges give no rows. Every round is a written table; only whether any row is out of
    place reaches the driver.
    """
    current = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    current = tables.write(current, "edges")
    while not _settled(current):
        large = tables.write(_large_star(current), "edges")
        tables.drop(current)
        current = tables.write(_small_star(large).filter("a <> b").distinct(), "edges")
        tables.drop(large)
    pairs = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return pairs.union(pairs.select("component", "component").distinct())
