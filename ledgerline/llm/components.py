"""Connected components of links, by rounds of DataFrame joins.

Each round is a large-star step (every vertex sends its larger neighbours to its least one)
and a small-star step (its smaller neighbours and itself to the least one). The links become
stars after a number of rounds that grows with the logarithm of the longest path. Only
minima are gathered by vertex, so they are summed before a shuffle; no vertex's links have to
meet in one task but in a join, which Spark may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _star(links: DataFrame) -> DataFrame:
    """links (a, b), a > b: one round."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a > b")
    # what was the least neighbour's own link stays
    large = large.distinct()
    small = large.groupBy("a").agg(F.min("b").alias("m"))
    moved = large.join(small, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(small.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """links: a, b long. Returns vertex and component (the least vertex that links lead to),
    for every vertex that has a link to another."""
    own = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    own = common.saved(own, "links")
    before = None
    while True:
        now = own.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if before == now:
            break
        before = now
        if not now[0]:
            break
        after = common.saved(_star(own), "links")
        common.forget(own)
        own = after
    stars = own.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
    return stars.unionByName(own.select(F.col("b").alias("vertex"), F.col("b").alias("component")).distinct())
