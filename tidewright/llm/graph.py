"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import materialise


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node`` and ``component``, the smallest node it is connected with, for all nodes of the edges.

    ``edges`` has columns ``a`` and ``b``.  Large and small stars take turns: every node first
    hangs its larger, then its smaller neighbours on the smallest one it knows.  The number of
    edges does not grow and each round is written, so a round reads files and no long lineage.
    The driver sees a count and a checksum per round.
    """
    stars = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    stars = materialise(stars, f"{label}-edges")
    seen = _signature(stars)
    while seen[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = materialise(small.unionByName(smallest.withColumnRenamed("m", "v")).distinct(), f"{label}-stars")
        now = _signature(stars)
        if now == seen:
            break
        seen = now
    leaves = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())
