"""Connected components by alternating stars over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hardwood.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """node and root (the smallest node reachable) of every node in ``links`` (a long, b long).

    Each round points all neighbours of a node at its smallest neighbour, the
    larger ones first (large star), then the smaller ones (small star). Rounds grow with
    the logarithm of the longest chain; a hub's neighbours are folded to a minimum before the shuffle. Every round is
    written to the shared folder; the driver sees two numbers a round.
    """
    links = staged(links.selectExpr("greatest(a, b) as a", "least(a, b) as b").filter("a != b").distinct(), "links")
    before = None
    while True:
        both = links.union(links.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("low").alias("b")).distinct()
        large = staged(large.filter("a != b"), "large")
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").selectExpr("b as a", "low as b").filter("a != b").union(low.select("a", F.col("low").alias("b")))
        links = staged(small.distinct(), "small")
        state = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select("b", "b").distinct())
        before = state
