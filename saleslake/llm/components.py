"""Connected components of a graph of links, by alternating star contraction.

Every round hangs the neighbours of a node on the smallest of them, once for the larger and once
for the smaller neighbours, until the graph is a forest of stars. Nothing is collected, and a node
with very many links is an aggregate and a join, which Spark can split.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.llm.tables import drop, stored


def components(links: DataFrame) -> DataFrame:
    """``node`` and its smallest reachable node ``component``, for all nodes of links (a, b) but the smallest ones."""
    high, low = F.greatest("a", "b"), F.least("a", "b")
    links = links.where(F.col("a") != F.col("b")).select(high.alias("high"), low.alias("low"))
    now = stored(links.distinct())
    seen = None
    while seen != (mark := _fingerprint(now)):
        seen, before = mark, now
        now = stored(_small_star(_large_star(before)))
        drop(before)
    return now.select(F.col("high").alias("node"), F.col("low").alias("component"))


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low")), F.sum(F.hash("high", "low"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.selectExpr("high u", "low v").unionByName(links.selectExpr("low u", "high v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u AND v != m").selectExpr("v high", "m low").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("high").agg(F.min("low").alias("m"))
    joined = links.join(least, "high")
    hung = joined.where("low != m").selectExpr("low high", "m low")
    return hung.unionByName(least.selectExpr("high", "m low")).distinct()
