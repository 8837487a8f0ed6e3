"""Dense ids that continue from an existing table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..durable import materialise

_PARTITION_BITS = 33


def surrogate_ids(
    df: DataFrame,
    order_by: Sequence[str],
    existing: DataFrame,
    id_column: str,
    parts: int | None = None,
) -> DataFrame:
    """Number rows 1, 2, 3 … in key order, continuing from the largest id in ``existing``.

    Rows are range-partitioned and sorted per partition, written once (range bounds come from a
    sample, so the layout must not be computed twice), and numbered as offset of the partition
    plus position in it.  Only one row per partition goes through the offset window.
    """
    spread = (
        df.repartitionByRange(*order_by)
        if parts is None
        else df.repartitionByRange(parts, *order_by)
    )
    placed = materialise(
        spread.sortWithinPartitions(*order_by)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", _PARTITION_BITS))
        .withColumn("_row", F.col("_row") - F.shiftleft("_part", _PARTITION_BITS)),
        "numbered",
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset")
    )
    start = existing.agg(
        F.coalesce(F.max(F.col(id_column).try_cast("long")), F.lit(0)).alias("last_id")
    ).scalar()
    return placed.join(offsets, "_part").select(
        (F.col("_row") + F.col("_offset") + 1 + start).cast("long").alias(id_column), *df.columns
    )
