"""Connected components by alternating large-star and small-star steps over written link tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b), both long: the root is the component's smallest node.

    Each round halves the depth of the trees at least roughly; joins on a hot node meet a side with one row per node, so
    that Spark can split them. No links: no rows. Links with a null end or equal ends are ignored.
    """
    edges = links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
    edges = materialise(edges.filter("v <> u").distinct(), "links")
    while True:
        both = edges.select("v", "u").union(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = materialise(both.groupBy("v").agg(F.least("v", F.min("u")).alias("m")), "least")
        large = both.filter("u > v").join(least, "v").select(F.col("u").alias("v"), F.col("m").alias("u")).distinct()
        large = materialise(large, "large-star")
        low = materialise(large.groupBy("v").agg(F.min("u").alias("m")), "least")
        kept = large.join(low, "v").select(F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u")).alias("v"),
                                           F.col("m").alias("u"))
        after = materialise(kept.filter("v <> u").distinct(), "small-star")
        if _same(edges, after):
            return after.select(F.col("v").alias("node"), F.col("u").alias("root")).union(
                after.select("u", "u").distinct())
        edges = after


def _same(before: DataFrame, after: DataFrame) -> bool:
    """Whether a round changed nothing, by count and sum of a hash of the links."""
    def seal(df):
        h = F.xxhash64("v", "u").cast("decimal(38,0)")
        return tuple(df.agg(F.count("*"), F.sum(h)).first())
    return seal(before) == seal(after)
