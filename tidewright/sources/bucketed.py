"""Tables bucketed on shared keys, so that they meet again and again without being moved."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import SLICES, hot_hashes

SLICE = "_slice"


def _is_hot(keys: Sequence[str], hot: Sequence[int]) -> Column:
    return F.xxhash64(*keys).isin(list(hot)) if hot else F.lit(False)


def _store(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """One file per bucket: rows are dealt by the hash that also names the bucket."""
    by = [*keys, SLICE]
    df.repartition(buckets, *by).write.mode("overwrite").option("path", path).bucketBy(buckets, *by).sortBy(
        *by
    ).saveAsTable(table)
    return df.sparkSession.table(table)


def store_bucketed(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    buckets: int,
    tables: tuple[str, str],
    folder: str,
) -> tuple[DataFrame, DataFrame]:
    """Store a fact table and the table it is looked up in, both bucketed on ``keys`` and a slice.

    The facts of hot keys are dealt over slices, and their lookup rows are repeated once per slice,
    so no bucket holds a whole hot key.  The hot keys are counted when the two are stored, and both
    are stored together.  Returns the two catalogue tables.
    """
    hot = hot_hashes(facts, keys)
    zero = F.lit(0).cast("int")
    row = [c for c in facts.columns if c not in keys] or list(keys)
    place = F.pmod(F.xxhash64(*row), F.lit(SLICES)).cast("int")
    every = F.sequence(zero, F.lit(SLICES - 1).cast("int"))
    is_hot = _is_hot(keys, hot)
    dealt = facts.withColumn(SLICE, F.when(is_hot, place).otherwise(zero))
    repeated = lookup.withColumn(SLICE, F.explode(F.when(is_hot, every).otherwise(F.array(zero))))
    return (
        _store(dealt, tables[0], f"{folder}/{tables[0]}", keys, buckets),
        _store(repeated, tables[1], f"{folder}/{tables[1]}", keys, buckets),
    )


def join_bucketed(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join two tables of ``store_bucketed``: the buckets meet as they lie, without an exchange."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only joins that keep the fact side whole can use the slices")
    return facts.hint("merge").join(lookup, [*keys, SLICE], how).drop(SLICE)


def buckets_for(spark: SparkSession, path: str, bytes_per_bucket: int = 16 << 20) -> int:
    """Buckets so that each holds about ``bytes_per_bucket`` of the files under ``path``.

    One task sorts a bucket, and rows take many times their size in the file when they are sorted.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return max(1, -(-files.getContentSummary(folder).getLength() // bytes_per_bucket))
