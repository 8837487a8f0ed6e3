"""Distinct counts that can be merged: one bitmap per key, day and range of ids."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_bitmaps(rows: DataFrame, keys: Sequence[str], counted: str, day: str = "date") -> DataFrame:
    """(keys, day, ``bucket``, ``bits``): which ids of ``counted`` (whole numbers) a key has on a day.

    A bitmap covers 32,768 neighbouring ids, so a key with dense ids needs few of them and a group
    is never collected.  Null ids are not counted.
    """
    return (
        rows.where(F.col(counted).isNotNull())
        .select(*keys, day, F.bitmap_bucket_number(counted).alias("bucket"), F.bitmap_bit_position(counted).alias("_bit"))
        .groupBy(*keys, day, "bucket")
        .agg(F.bitmap_construct_agg("_bit").alias("bits"))
    )


def distinct_over(
    bitmaps: DataFrame, keys: Sequence[str], name: str, first: dt.date, last: dt.date, day: str = "date"
) -> DataFrame:
    """Distinct ids per key over the days from ``first`` to ``last``, merged from daily bitmaps.

    The fact table is not read again; bitmaps of other days are not read either where the table is
    partitioned by day.
    """
    merged = (
        bitmaps.where(F.col(day).between(F.lit(first), F.lit(last)))
        .groupBy(*keys, "bucket")
        .agg(F.bitmap_or_agg("bits").alias("_bits"))
    )
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("_bits")).alias(name))
