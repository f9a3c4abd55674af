"""Connected components of a link table, by alternating large and small stars.

Each round is a grouped minimum and a join back, so a hub with very many links is summed before
the shuffle and its rows are split by the adaptive join; no component meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from loomframe.session import stage


def _with_smallest(links: DataFrame) -> DataFrame:
    """Links (u, v) with the smallest of u and all its v as m."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return links.join(least, "u").withColumn("m", F.least("u", "m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """``links`` point down (u > v)."""
    pairs = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
    return _with_smallest(links).select(F.inline(pairs)).where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(u, v) of any links -> (u, v): every node but the smallest of its component, and that one.

    Links may repeat, point either way, and join a node to itself; nulls are left out. No links,
    no rows. Rounds end when a round changes nothing, after about the logarithm of the longest
    chain.
    """
    ordered = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found, mark = stage(ordered.distinct(), "links"), None
    while True:
        sums = found.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if tuple(sums) == mark or not sums[0]:
            return found
        mark = tuple(sums)
        found = stage(_small_star(_large_star(found)), "links")
