"""Which days still have to be processed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import days_after


def calendar(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """One row per day from ``first`` to ``last``."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))


def days_between(bounds: DataFrame) -> DataFrame:
    """Days of a one-row (first, last) frame, so the bounds need not visit the driver."""
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date"))


def pending_days(
    days: DataFrame,
    done: DataFrame,
    after: dt.date | None = None,
    before: dt.date | None = None,
    done_day: str = "date",
    limit: int | None = None,
) -> DataFrame:
    """Days strictly inside (after, before) that ``done`` lacks; ``limit`` keeps the newest."""
    wanted = days.select(F.col("date").cast("date").alias("date"))
    if after is not None:
        wanted = wanted.where(F.col("date") > F.lit(after))
    if before is not None:
        wanted = wanted.where(F.col("date") < F.lit(before))
    finished = done.select(F.to_date(F.col(done_day)).alias("date")).distinct()
    left = wanted.join(finished, "date", "left_anti")
    return left if limit is None else left.orderBy(F.desc("date")).limit(limit)


def days_to_analyse(done: DataFrame, today: dt.date, done_day: str = "date") -> DataFrame:
    """Days after the newest finished day up to ``today``; the first run takes today only."""
    newest = done.agg(F.max(F.to_date(F.col(done_day))).alias("newest"))
    end: Column = F.lit(today)
    days = F.when(F.col("newest").isNull(), F.array(end)).otherwise(
        days_after(F.col("newest"), end)
    )
    return newest.select(F.explode(days).alias("date"))
