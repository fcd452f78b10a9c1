"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014).

Each step is a grouping and a join over the links, written to the shared folder, so nothing depends
on how long a chain of links is or on what the driver can hold. The links shrink towards stars whose
centre is the smallest member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respondry.sources.workspace import written


def _star(links: DataFrame) -> DataFrame:
    """Each ``node`` with every ``other`` it is linked to, joined to the smallest of all of these."""
    least = links.groupBy("node").agg(F.min("other").alias("least"))
    return links.join(least, "node").withColumn("least", F.least("least", "node"))


def _large(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("other").alias("node"), F.col("node").alias("other")))
    star = _star(both).where("other > node")
    return star.select(F.col("other").alias("node"), F.col("least").alias("other")).where("node <> other").distinct()


def _small(links: DataFrame) -> DataFrame:
    star = _star(links)
    again = star.select(F.col("other").alias("node"), F.col("least").alias("other"))
    own = star.select("node", F.col("least").alias("other")).distinct()
    return again.union(own).where("node <> other").distinct()


def components(links: DataFrame, first: str, second: str) -> DataFrame:
    """``node`` and the smallest ``component`` reachable from it, for every node of some link.

    Links are pairs of long ids in any order and number; pairs with a null or with itself are left
    out. Without links the result is empty.
    """
    low, high = F.least(first, second), F.greatest(first, second)
    links = links.where(F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col(first) != F.col(second)))
    links = written(links.select(high.alias("node"), low.alias("other")).distinct(), "links")
    before = None
    while True:
        links = written(_small(_large(links)), "links")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if state == before:
            return links.groupBy("node").agg(F.min("other").alias("component")).union(
                links.select("other", F.col("other").alias("component")).distinct()
            )
        before = state
