"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.scale import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every greater neighbour of a node is linked to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = both.join(least, "a").filter("b > a")
    return joined.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node with a link; the component is its smallest node.

    Each round makes every tree of links flatter and writes the links, so the
    plan stays short; rounds end when the links no longer change, after about
    the logarithm of the longest path. Links are aggregated before they are
    joined, and a node with very many links is split by AQE.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)), F.coalesce(F.sum("b"), F.lit(0))
        ).first()
        if state == seen:
            break
        seen = state
        edges = _small_star(_large_star(edges)).filter("a <> b").distinct()
        edges = written(edges)
    tops = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)
