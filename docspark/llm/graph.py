"""Connected components of a link table, by alternating large-star and small-star rounds.

All steps are joins and grouped minima over link rows; nothing is gathered on the driver
but two totals a round. A node with very many links is met by partial minima before the
shuffle and by Spark's skewed-join splitting after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root for every node that has a link; root: the smallest node reachable. links: a, b (long)."""
    now = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    for _ in range(most_rounds):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state, before = seen, now
        now = cut(_small_star(_large_star(now)))
        drop(before)
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")
