"""Connected components by alternating large and small stars, each round a pair of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urlsift.llm.common import drop_written, written


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _stars(links: DataFrame, larger: bool) -> DataFrame:
    """Hang every neighbour on the smallest of a node's neighbours and itself: those larger than
    the node, or those not larger together with the node."""
    low = links.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low"))
    hung = links.join(low, "a")
    if larger:
        out = hung.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).union(low.select("a", F.col("low").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of one type; returns (node, root) for each node that isn't its component's
    smallest. Rounds follow the logarithm of the size, not the diameter; each is written to the shared folder."""
    now = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "stars")
    state = None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = seen
        large = _stars(_both(now), True)
        after = written(_stars(large, False), "stars")
        drop_written(now)
        now = after
