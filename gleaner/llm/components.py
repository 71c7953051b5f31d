"""Connected components by alternating large-star and small-star steps; links never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gleaner.llm.common import pinned


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of `links` (a, b): root is the smallest node of its component.

    Hubs are looked up by a join with one row per node, so a hub's links may lie in many partitions.
    """
    edges = pinned(_ordered(links.select("a", "b")), "links")
    last = None
    while True:
        edges = pinned(_small_star(_large_star(edges)), "stars")
        state = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == last:
            break
        last = state
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _ordered(links: DataFrame) -> DataFrame:
    """Distinct links from the larger node u to the smaller v."""
    pair = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    return pair.distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    edges = _ordered(links)
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return _ordered(moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
