"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from scoutlab.llm.common import settle


def components(links: DataFrame) -> DataFrame:
    """node, part (the smallest node it is linked with) for the nodes in ``links`` (u, v).

    Every step is a grouped minimum, partially aggregated, and a join; no
    node's neighbours are gathered.  Each round is written to the shared
    folder; the number of rounds grows with the logarithm of the links.
    """
    edges = settle(links.filter("u <> v").select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct(), "links")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        edges = settle(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if now == mark:
            break
        mark = now
    parts = edges.select(F.col("a").alias("node"), F.col("b").alias("part"))
    return settle(parts.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("part"))).distinct(), "parts")
