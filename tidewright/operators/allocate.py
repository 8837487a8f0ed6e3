"""Spreading an order-level amount over the order's parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE_TYPE = "decimal(19,12)"
AMOUNT_TYPE = "decimal(18,4)"


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as a double; null when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def shares(parts: DataFrame, order_key: str, weight: str) -> DataFrame:
    """Add ``share`` of each part in its order's total weight; a zero total gives null.

    ``parts`` is an aggregate with one row per order and category, so an order has no more rows
    than there are categories and no order is hot, however many lines it has.  Totals are an
    aggregate of it joined back; both sides come from the same shuffle of the parts.
    """
    totals = parts.groupBy(order_key).agg(F.sum(weight).alias("_total"))
    return (
        parts.join(totals, order_key)
        .withColumn("share", ratio(F.col(weight), F.col("_total")).cast(SHARE_TYPE))
        .drop("_total")
    )


def spread(
    amounts: DataFrame,
    parts: DataFrame,
    order_key: str,
    amount: str,
    keys: Sequence[str],
    alias: str,
    how: str = "inner",
    by: Sequence[str] = (),
) -> DataFrame:
    """Sum ``amount * share`` over the orders, at the grain ``keys``.

    Both sides are aggregates per order: an order meets as its payment methods, activities or the
    like times its categories, which do not grow with its lines.

    With ``by``, those of the keys that all amounts of an order have in common, an order is moved
    as one row with its amounts and its parts as arrays, and the pairs are formed where they are
    summed, so no shuffle moves them.
    """
    amounts = amounts.withColumn(amount, F.col(amount).cast(AMOUNT_TYPE))
    if not by:
        pairs = amounts.join(parts, order_key, how)
    else:
        own = [c for c in keys if c in amounts.columns and c not in by]
        part = [c for c in keys if c not in amounts.columns]
        orders = amounts.groupBy(order_key, *by).agg(F.collect_list(F.struct(*own, amount)).alias("_amounts"))
        orders = orders.join(
            parts.groupBy(order_key).agg(F.collect_list(F.struct(*part, "share")).alias("_parts")), order_key, how
        )
        columns = [*[f"_amounts.{c}" for c in (*own, amount)], *[f"_parts.{c}" for c in (*part, "share")]]
        # An array for each column is narrower than one of rows.
        pairs = orders.select(*by, *columns).repartition(*by)
        pairs = pairs.select(*by, *part, "share", F.inline(F.arrays_zip(*own, amount)))
        pairs = pairs.select(*by, *own, amount, F.inline_outer(F.arrays_zip(*part, "share")))
    return pairs.groupBy(*keys).agg(F.sum(F.col(amount) * F.col("share")).alias(alias))
