"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.session import cut_lineage


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of ``edges`` (a, b) but the smallest of each component.

    Each round hangs the larger neighbours of a node, then the node itself, under
    the smallest neighbour, until nothing moves. Rounds are written to the shared
    folder and removed once the next has been written. The smallest neighbours are a table of their own, so the join with a
    node of very many edges has shuffles that Spark can split.
    """
    stars = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now
        both = stars.union(stars.select("v", "u"))
        near = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(large.distinct(), spent=[near, stars])
        least = cut_lineage(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut_lineage(small.union(least.select("u", "m")).distinct(), spent=[least, large])
