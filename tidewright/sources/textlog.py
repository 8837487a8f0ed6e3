"""Run-log text with exact physical line numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_log(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Read log files as (file, line_no, value); every physical line counts, blank ones too.

    Lines of one file block sit in one task in file order, so an id taken on the scan gives
    the position inside the block.  Only (file, block, first id, count) rows are shuffled and
    summed to block offsets; the lines themselves are never sorted.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_id"),
        "value",
    )
    blocks = lines.groupBy("file", "block").agg(
        F.min("row_id").alias("first_id"), F.count(F.lit(1)).alias("n_lines")
    )
    before = (
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = blocks.select(
        "file",
        "block",
        (F.coalesce(F.sum("n_lines").over(before), F.lit(0)) - F.col("first_id") + 1).alias("shift"),
    )
    # A block holds at most one input split, so (file, block) has no hot key.
    return lines.join(offsets, ["file", "block"]).select(
        "file", (F.col("row_id") + F.col("shift")).alias("line_no"), "value"
    )
