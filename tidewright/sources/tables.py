"""Parquet warehouse tables: full refresh, incremental append and day-partition reload."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import newer_than, newer_than_per_source

# Mark of a target that is still empty when the caller names none.
EARLIEST = dt.datetime(1900, 1, 1)
FULL, BY_ID, BY_TIME, BY_SOURCE = "full", "by_id", "by_time", "by_source"


def full_refresh(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def reload_days(
    df: DataFrame,
    path: str,
    first: dt.date | None = None,
    last: dt.date | None = None,
    day: str = "date",
) -> None:
    """Replace the days from ``first`` to ``last`` by the rows of ``df``; other days stay.

    A day of the range for which ``df`` has no rows is emptied.  Rows outside the range are not
    written.  Without a range only the days present in ``df`` are replaced.  Days with rows are
    swapped when the write commits; a day to be emptied loses its folder after that, so a failed
    run can simply be repeated.

    Rows are rebalanced by day: small days share a task, and adaptive execution cuts a busy day
    into several tasks and files.
    """
    if (first is None) != (last is None):
        raise ValueError("a range has two ends")
    rows = df if first is None else df.where(F.col(day).between(F.lit(first), F.lit(last)))
    kept: set[dt.date] = set()
    if first is not None:  # at most one value per day of the range reaches the driver
        kept = {r[0] for r in rows.select(day).distinct().collect()}
    (
        rows.hint("rebalance", F.col(day))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    if first is not None:
        _drop_days(df.sparkSession, path, first, last, day, kept)


def _drop_days(
    spark: SparkSession, path: str, first: dt.date, last: dt.date, day: str, kept: set[dt.date]
) -> None:
    """Delete the day folders of the range that are not among ``kept``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for offset in range((last - first).days + 1):
        date = first + dt.timedelta(days=offset)
        partition = spark._jvm.org.apache.hadoop.fs.Path(folder, f"{day}={date.isoformat()}")
        if date not in kept and files.exists(partition):
            files.delete(partition, True)


def read_days(
    spark: SparkSession, path: str, first: dt.date, last: dt.date, day: str = "date"
) -> DataFrame:
    """Read a run of day partitions; the other folders are pruned before any file is opened."""
    return spark.read.parquet(path).where(F.col(day).between(F.lit(first), F.lit(last)))


def extract(
    source: DataFrame,
    target: DataFrame | None,
    mode: str,
    key: str = "id",
    columns: list[str] | None = None,
    floor=None,
    source_keys: list[str] | None = None,
) -> DataFrame:
    """Rows of ``source`` to be loaded: everything, or those past the target's high-water mark."""
    rows = source
    if mode == BY_ID:
        rows = newer_than(source, target, key, floor=0 if floor is None else floor)
    elif mode == BY_TIME:
        rows = newer_than(source, target, key, floor=EARLIEST if floor is None else floor)
    elif mode == BY_SOURCE:
        rows = newer_than_per_source(source, target, key, source_keys or ["origin_system"])
    elif mode != FULL:
        raise ValueError(f"unknown extract mode {mode!r}")
    return rows if columns is None else rows.select(*columns)
