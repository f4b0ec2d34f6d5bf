"""Connected components of a table of links, by rounds of joins and minimum aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.session import stage


def _large_star(links: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    smaller = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return smaller.filter("a <> b").unionByName(least.select("a", F.col("least").alias("b")))


def connected(links: DataFrame) -> DataFrame:
    """``a`` and ``b``, the least node reachable from it, for each node that is not itself the least.

    ``links`` has numbers ``a`` and ``b``. Star rounds halve the depth of the
    trees, so their number grows with the logarithm of the longest path. Every
    round is a written table: no lineage grows, and a lost executor costs tasks
    of one round.
    """
    links = stage(links.filter("a <> b").select("a", "b").distinct())
    before = None
    while True:
        links = stage(_small_star(stage(_large_star(links).distinct())).distinct())
        state = links.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.sum(F.hash("b", "a").cast("bigint"))
        ).first()
        if state == before or state[0] == 0:
            return links
        before = state
