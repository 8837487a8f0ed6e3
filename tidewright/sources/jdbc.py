"""Database tables.  Connection details always come from the caller."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FETCH_SIZE = 20_000
APPEND_BATCH = 10_000
OVERWRITE_BATCH = 500


@dataclass(frozen=True)
class Split:
    """Parallel read on a numeric, date or timestamp column; open bounds are probed."""

    column: str
    partitions: int
    lower: object | None = None
    upper: object | None = None


def _reader(spark: SparkSession, options: Mapping[str, str], table: str):
    return (
        spark.read.format("jdbc")
        .options(**{"fetchsize": str(FETCH_SIZE), **options})
        .option("dbtable", table)
    )


def read_jdbc(
    spark: SparkSession, options: Mapping[str, str], table: str, split: Split | None = None
) -> DataFrame:
    """Read a table; without a split it is one task, which suits small dimensions only."""
    if split is None:
        return _reader(spark, options, table).load()
    lower, upper = split.lower, split.upper
    if lower is None or upper is None:
        # min/max are pushed into the database; one row comes back.
        probe = (
            _reader(spark, options, table)
            .option("pushDownAggregate", "true")
            .load()
            .agg(F.min(split.column).alias("lo"), F.max(split.column).alias("hi"))
            .first()
        )
        lower = probe["lo"] if lower is None else lower
        upper = probe["hi"] if upper is None else upper
    if lower is None:
        return _reader(spark, options, table).load()
    return (
        _reader(spark, options, table)
        .option("partitionColumn", split.column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(split.partitions))
        .load()
    )


def append_jdbc(
    df: DataFrame, options: Mapping[str, str], table: str, batch: int = APPEND_BATCH
) -> None:
    """Add rows to a table without a surrounding transaction per task."""
    (
        df.write.format("jdbc")
        .options(**{"isolationLevel": "NONE", **options})
        .option("batchsize", str(batch))
        .option("dbtable", table)
        .mode("append")
        .save()
    )


def overwrite_jdbc(
    df: DataFrame,
    options: Mapping[str, str],
    table: str,
    truncate: bool = True,
    batch: int = OVERWRITE_BATCH,
) -> None:
    """Replace the rows of a table; with ``truncate`` its columns and indexes stay as they are."""
    (
        df.write.format("jdbc")
        .options(**options)
        .option("batchsize", str(batch))
        .option("truncate", str(truncate).lower())
        .option("dbtable", table)
        .mode("overwrite")
        .save()
    )
