"""Connected components of a large graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwise.llm.frames import stored


def _to_least(pairs: DataFrame) -> DataFrame:
    """Each node's least neighbour or itself; partial aggregation keeps a node with very many neighbours cheap."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_to_least(both), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    least = _to_least(links)
    moved = links.join(least, "u").where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """node and component (the least node that can be reached) of every node that has a link to another.

    ``links`` has columns u and v of type long; direction, repeats and links of a node to itself do not matter; no links give no rows.
    Each round is written to the shared folder; the number of rounds grows with the logarithm of the longest path.
    """
    ordered = links.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now = stored(ordered, "links")
    before = None
    while True:
        now = stored(_small_star(_large_star(now).distinct()).distinct(), "links")
        after = _state(now)
        if after == before or not after[0]:
            break
        before = after
    # Every node now points straight at the least of its component, which has no row of its own yet.
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
