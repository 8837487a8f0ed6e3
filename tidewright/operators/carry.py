"""Values that hold until the next one: carried from line to line across the blocks of a file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Lines per block, at every size.
BLOCK_LINES = 1_000_000


def carry_forward(
    lines: DataFrame,
    value: Column,
    name: str,
    before: DataFrame | None = None,
    block_lines: int | None = None,
) -> DataFrame:
    """Add ``name``: the last known ``value`` at or before each line (file, line_no) of its file.

    Inside a block of ``block_lines`` lines a window finds it.  What a block inherits is the last
    value of the blocks before it: one row per block is summed up and passes the window over a
    file, the lines never do.  ``before`` (file, ``name``) holds what earlier runs left behind.
    """
    width = block_lines or BLOCK_LINES
    rows = lines.withColumns({"_block": F.floor(F.col("line_no") / F.lit(width)), "_value": value})
    known = F.when(F.col("_value").isNotNull(), F.col("line_no"))
    blocks = rows.groupBy("file", "_block").agg(F.max_by("_value", known).alias("_last"))
    earlier = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inherited = blocks.select(
        "file", "_block", F.last("_last", ignorenulls=True).over(earlier).alias("_inherited")
    )
    if before is not None:
        left = before.select("file", F.col(name).alias("_left"))
        inherited = inherited.join(left, "file", "left").withColumn(
            "_inherited", F.coalesce("_inherited", "_left")
        ).drop("_left")
    inside = (
        Window.partitionBy("file", "_block").orderBy("line_no")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_value", F.last("_value", ignorenulls=True).over(inside))
        .join(inherited, ["file", "_block"])
        .withColumn(name, F.coalesce("_value", "_inherited"))
        .drop("_block", "_value", "_inherited")
    )


def last_known(lines: DataFrame, name: str) -> DataFrame:
    """(file, ``name``) at the last line of each file, to go on from in a later run."""
    return lines.groupBy("file").agg(F.max_by(name, "line_no").alias(name))
