"""High-water marks from the footers of Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTINGS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose Parquet scans answer min, max and count from footers."""
    session = spark.newSession()
    for key, value in _SETTINGS.items():
        session.conf.set(key, value)
    return session


def footer_bounds(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row: ``rows`` and for each column ``min_`` and ``max_``; only footers are read.

    Columns are whole numbers, floats, booleans or dates, for which footers hold exact bounds.  The
    frame belongs to a session of its own; take its values, not the frame, into other queries.
    """
    bounds = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return footer_session(spark).read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), *bounds)


def newer_than_stored(source: DataFrame, path: str, key: str, floor: int = 0) -> DataFrame:
    """Rows of ``source`` past the largest ``key`` stored under ``path``; the mark reaches the scan."""
    mark = footer_bounds(source.sparkSession, path, [key]).first()[f"max_{key}"]
    return source.where(F.col(key) > F.lit(floor if mark is None else max(mark, floor)))
