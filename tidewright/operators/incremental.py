"""High-water-mark loads and source merging."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import materialise
from .skew import split_join


def high_water(target: DataFrame, key: str, floor) -> DataFrame:
    """One row, one column ``mark``: the largest key loaded so far, never under ``floor``."""
    kind = target.schema[key].dataType
    # Ids kept as text are compared as numbers.
    as_number = kind.typeName() == "string" and isinstance(floor, int)
    value = F.col(key).try_cast("long") if as_number else F.col(key)
    low = F.lit(floor) if as_number else F.lit(floor).cast(kind)
    return target.agg(F.greatest(F.coalesce(F.max(value), low), low).alias("mark"))


def newer_than(source: DataFrame, target: DataFrame, key: str, floor=0) -> DataFrame:
    """Rows past the mark.  The mark is a scalar subquery, so it reaches the scan as a filter."""
    as_number = source.schema[key].dataType.typeName() == "string" and isinstance(floor, int)
    value = F.col(key).try_cast("long") if as_number else F.col(key)
    return source.where(value > high_water(target, key, floor).scalar())


def newer_than_per_source(
    source: DataFrame, target: DataFrame, key: str, source_keys: Sequence[str]
) -> DataFrame:
    """One mark per origin; an origin the target has never seen starts from zero.

    The marks are written first: Spark then knows how few they are and broadcasts them, instead
    of shuffling the source by a key with a handful of values.
    """
    marks = materialise(target.groupBy(*source_keys).agg(F.max(key).alias("_mark")), "marks")
    return (
        source.join(marks, list(source_keys), "left")
        .where(F.col(key) > F.coalesce(F.col("_mark"), F.lit(0)))
        .select(*source.columns)
    )


def first_source_wins(first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of ``first`` plus the rows of ``second`` whose key it lacks."""
    return first.unionByName(second.join(first.select(*keys), list(keys), "left_anti"))


def align(df: DataFrame, schema: Mapping[str, Column | None], types: Mapping[str, str]) -> DataFrame:
    """Project onto a shared layout; columns a source lacks become typed nulls."""
    return df.select(
        *[
            (F.lit(None) if value is None else value).cast(types[name]).alias(name)
            for name, value in schema.items()
        ]
    )


def translate_codes(df: DataFrame, names: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace old codes by new ones where ``names`` (old, new) knows them."""
    known = names.where(F.col("old").isNotNull()).groupBy("old").agg(F.min("new").alias("new"))
    out = df
    for column in columns:
        renamed = known.select(F.col("old").alias(column), F.col("new").alias("_new"))
        out = (
            split_join(out, renamed, [column], "left", keys_of=df)
            .withColumn(column, F.coalesce("_new", column))
            .drop("_new")
        )
    return out.select(*df.columns)
