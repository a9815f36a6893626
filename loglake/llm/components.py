"""Connected components by alternating large-star and small-star steps over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake.sources.tables import scratch_table


def _large_star(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node goes to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    larger = both.where("b > a").join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of these."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node with a link: root is the smallest node it reaches.

    `links` has columns a and b of one ordered type, in either direction, repeats and loops
    allowed; nodes that have loops only are left out. Every step is stored,
    so a lost executor costs one step at most; only a count and a checksum come to the driver.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, before = scratch_table(ordered.distinct(), "links"), None
    while True:
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.max("a")
        ).first()
        if state == before:
            roots = current.select(F.col("b").alias("a"), "b").distinct()
            return current.unionByName(roots).select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
        current = scratch_table(_small_star(_large_star(current)), "links")
