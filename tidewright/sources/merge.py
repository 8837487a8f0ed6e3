"""Write columns back into a table of day partitions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import materialise


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return same


def repeated_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, nulls being equal, and how many each has."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def merge_days(
    path: str, updates: DataFrame, keys: Sequence[str], columns: Sequence[str], day: str = "date"
) -> list[dt.date]:
    """Set ``columns`` of the rows under ``path`` that have the key and day of an update.

    ``keys`` and the day together must be unique among the updates, null being a value like any
    other; else nothing is written.  Rows without an update keep their values, updates without a
    row are not inserted.  Only the day partitions that updates name are read and written; the
    others keep their files.  The new partitions are written aside first, since they are read from
    the place they go to, and swapped in by one commit.  Returns the days that were written.
    """
    spark = updates.sparkSession
    on = [day, *keys]
    changes = materialise(updates.select(*on, *columns), "merge-updates")
    wrong = repeated_keys(changes, on).first()
    if wrong is not None:
        raise ValueError(f"more than one update for {wrong.asDict()}")
    days = sorted(r[0] for r in changes.select(day).distinct().collect() if r[0] is not None)
    if not days:
        return []
    old = spark.read.parquet(path).where(F.col(day).isin(days))
    found = changes.where(F.col(day).isNotNull()).withColumn("_found", F.lit(True))
    merged = old.alias("o").join(found.alias("u"), _same("o", "u", on), "left")
    new = merged.select(*[
        F.when(F.col("u._found"), F.col(f"u.{c}")).otherwise(F.col(f"o.{c}")).cast(old.schema[c].dataType).alias(c)
        if c in columns else F.col(f"o.{c}")
        for c in old.columns
    ])
    materialise(new, "merged-days").hint("rebalance", F.col(day)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(day).parquet(path)
    return days
