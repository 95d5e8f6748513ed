"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aljibe.session import staged


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node it reaches) for every node of ``links`` (columns ``a``, ``b``). Runs jobs.

    Alternating stars: every node hands its larger neighbours to the smallest one, then its smaller neighbours. The
    links shrink to one star per component in a number of rounds that grows with the logarithm of the longest path.
    Each round is written to the shared folder; the smallest neighbours are found by partial aggregation.
    """
    now = staged(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = now.union(now.select("b", "a"))
        least = staged(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")))
        large = staged(both.filter("b > a").join(least, "a").filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct())
        least = staged(large.groupBy("a").agg(F.min("b").alias("low")))
        small = large.join(least, "a").filter("b <> low").select(F.greatest("b", "low").alias("a"), F.least("b", "low").alias("b"))
        now = staged(small.union(least.select("a", F.col("low").alias("b"))).distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("b", "b"))
