"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tables


def _large_star(links: DataFrame) -> DataFrame:
    """Links each node's larger neighbours with the smallest node of its neighbourhood."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours with the smallest of them. All links lead from larger (a) to smaller (b)."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    return links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, tables: Tables) -> DataFrame:
    """(node, root) for every node of the links (a, b; long): root is the smallest node that links reach.

    Each round is two aggregations and two joins on single nodes; nothing but a count and a checksum reaches the
    driver. The number of rounds grows with the logarithm of the longest path.
    """
    state = lambda t: t.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    now = tables.put(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    was, first = state(now), now
    while was[0]:
        large = tables.put(_large_star(now).distinct(), "large")
        small = tables.put(_small_star(large).distinct(), "small")
        tables.drop(large, now)
        now, is_ = small, state(small)
        if is_ == was:
            break
        was = is_
    if was[0] == 0:
        return first.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
