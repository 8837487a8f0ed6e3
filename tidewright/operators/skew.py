"""Joins whose fact side may have a few keys holding a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than this part of the rows; at most 1/HOT_PART keys can.
HOT_PART = 0.005
SLICES = 64
BUCKETS = 4096

# Hot keys found before, by plan and key columns; only where to split depends on them.
_FOUND: dict[tuple, list[int]] = {}


def hot_hashes(df: DataFrame, keys: Sequence[str]) -> list[int]:
    """Hashes of the keys that hold more than HOT_PART of the rows.

    Rows are first counted in BUCKETS hash buckets, a plain hash aggregate.  A hot key makes its
    bucket heavy, so only heavy buckets, at most 1/HOT_PART of them and mostly none, are counted
    by key.  The driver gets BUCKETS counts and at most 1/HOT_PART hashes whatever the size of
    ``df``.  They are fetched once, because both sides of the join must agree on them even when
    tasks are run again, and kept for the next join of the same rows on the same keys.
    """
    name = (df.sparkSession.sparkContext.applicationId, df.select(*keys).semanticHash(), HOT_PART, *keys)
    if name not in _FOUND:
        _FOUND[name] = _count_hot(df, keys)
    return _FOUND[name]


def _count_hot(df: DataFrame, keys: Sequence[str]) -> list[int]:
    key = F.xxhash64(*keys)
    bucket = F.pmod(key, F.lit(BUCKETS))
    counts = {r[0]: r[1] for r in df.groupBy(bucket).count().collect()}
    limit = HOT_PART * sum(counts.values())
    heavy = [b for b, n in counts.items() if n > limit]
    if not heavy:
        return []
    found = (
        df.where(bucket.isin(heavy)).groupBy(key.alias("h")).count().where(F.col("count") > limit)
    )
    return sorted(r["h"] for r in found.collect())


def _left_to_broadcast(lookup: DataFrame) -> bool:
    """Does the optimiser's own estimate, in bytes, make it broadcast this side anyway?"""
    limit = lookup.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def split_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    keys_of: DataFrame | None = None,
) -> DataFrame:
    """Equi-join in which the fact rows of hot keys are dealt over SLICES tasks.

    The lookup rows of those keys, and only those, are repeated once per slice, so the result is
    the same as that of the plain join.  The key columns are read once more to find the hot keys;
    where ``facts`` is itself the result of joins, pass the scan it came from as ``keys_of``.  A
    lookup that Spark broadcasts by its size in bytes needs no shuffle and so no split.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("only joins that keep the fact side whole can be split on it")
    hot = [] if _left_to_broadcast(lookup) else hot_hashes(facts if keys_of is None else keys_of, keys)
    if not hot:
        return facts.join(lookup, list(keys), how)
    is_hot = F.xxhash64(*keys).isin(hot)
    zero = F.lit(0).cast("long")
    # The slice depends on the row and on the partition it lies in, so equal rows are dealt too.
    row = [c for c in facts.columns if c not in keys] or list(keys)
    place = F.pmod(F.xxhash64(*row, F.spark_partition_id()), F.lit(SLICES))
    dealt = facts.withColumn("_slice", F.when(is_hot, place).otherwise(zero))
    every = F.sequence(zero, F.lit(SLICES - 1).cast("long"))
    repeated = lookup.withColumn(
        "_slice", F.explode(F.when(is_hot, every).otherwise(F.array(zero)))
    )
    return dealt.join(repeated, [*keys, "_slice"], how).drop("_slice")


def deal(rows: DataFrame, keys: Sequence[str], keys_of: DataFrame) -> DataFrame:
    """Rows dealt by ``keys``, so that sums by these and more columns move none of them again.

    Where the scan ``keys_of`` has a key with too many rows for a task, they stay where they are and
    collapse to their sums before these move.
    """
    return rows if hot_hashes(keys_of, keys) else rows.repartition(*keys)


def deal_groups(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], group: Sequence[str], keys_of: DataFrame
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Facts dealt by ``keys``, for sums by ``keys`` and ``group`` that are joined to ``lookup`` next.

    Neither the sums nor the join move a row again.  Rows of hot keys are dealt over SLICES by their
    group, which so stays whole, and their lookup rows are repeated once per slice.  Returns both
    sides and the columns they meet on; these belong to the keys of the sums.
    """
    hot = hot_hashes(keys_of, keys)
    if not hot:
        return facts.repartition(*keys), lookup, list(keys)
    is_hot = F.xxhash64(*keys).isin(hot)
    zero = F.lit(0).cast("long")
    place = F.pmod(F.xxhash64(*group), F.lit(SLICES))
    every = F.sequence(zero, F.lit(SLICES - 1).cast("long"))
    on = [*keys, "_slice"]
    return (
        facts.withColumn("_slice", F.when(is_hot, place).otherwise(zero)).repartition(*on),
        lookup.withColumn("_slice", F.explode(F.when(is_hot, every).otherwise(F.array(zero)))),
        on,
    )
