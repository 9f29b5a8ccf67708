"""Connected components of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterglass.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of links (a, b) of longs; label: the smallest node it can reach.

    Each round hangs every node's neighbours on the smallest of them, larger ones first, then smaller ones. A node
    that holds a third of all links meets them as one minimum, summed before the shuffle, and a join that is split where it is
    skewed. The rounds' tables are written, so no lineage grows.
    """
    def least(edges: DataFrame) -> DataFrame:
        return stored(edges.groupBy(F.col("a").alias("m_a")).agg(F.min("b").alias("m")), "least")

    links = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    last = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        met = both.join(least(both), F.col("a") == F.col("m_a"))
        large = stored(met.where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).where("a <> b").distinct(), "links")
        met = large.join(least(large), F.col("a") == F.col("m_a"))
        small = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(met.select("a", F.col("m").alias("b")))
        links = stored(small.where("a <> b").distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    # All links are now from a node to the smallest one.
    return links.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
