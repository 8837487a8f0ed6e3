"""Cost batches: latest prices, new batches and the financial calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import on_days
from ..operators.numbering import surrogate_ids
from ..operators.skew import split_join

Day = dt.date | None
# Fixed value: part of the list price used as cost when no purchase is known.
FALLBACK_RATE = "0.62"


def latest_price(
    bills: DataFrame, bill_details: DataFrame, bill_type: str, purpose: str | None = None
) -> DataFrame:
    """(goods_code, last_time, cost_price): the discounted price on the newest document.

    Documents of one instant are told apart by the larger price.
    """
    wanted = bills.where(F.col("bill_type") == bill_type)
    if purpose is not None:
        wanted = wanted.where(F.col("bill_purpose") == purpose)
    price = (F.col("price") * F.col("discount")).cast("decimal(18,4)")
    newest = F.max(F.struct(F.col("create_time"), price.alias("price")))
    return (
        split_join(bill_details, wanted.select("bill_code", "create_time"), ["bill_code"])
        .groupBy("goods_code")
        .agg(newest.alias("_newest"))
        .select(
            "goods_code",
            F.col("_newest.create_time").alias("last_time"),
            F.col("_newest.price").alias("cost_price"),
        )
    )


def last_known_price(
    products: DataFrame, purchased: DataFrame, recounted: DataFrame, run_time: Column
) -> DataFrame:
    """Price and time of the last purchase, else of the last recount, else a part of list price."""
    bought = purchased.select(
        "goods_code", F.col("last_time").alias("_t1"), F.col("cost_price").alias("_p1")
    )
    counted = recounted.select(
        "goods_code", F.col("last_time").alias("_t2"), F.col("cost_price").alias("_p2")
    )
    fallback = (F.col("product_price") * F.lit(FALLBACK_RATE).cast("decimal(3,2)")).cast(
        "decimal(18,4)"
    )
    return (
        products.select(F.col("product_code").alias("goods_code"), "product_price")
        .join(bought, "goods_code", "left")
        .join(counted, "goods_code", "left")
        .select(
            "goods_code",
            F.coalesce("_t1", "_t2", run_time).alias("last_time"),
            F.coalesce(F.col("_p1"), F.col("_p2"), fallback).alias("cost_price"),
        )
    )


def candidate_goods(
    bills: DataFrame, bill_details: DataFrame, orders: DataFrame, order_details: DataFrame,
    first: dt.date, last: dt.date, stock: DataFrame | None = None,
) -> DataFrame:
    """Distinct goods with stock, documents or sales in the period."""
    period = on_days(F.col("create_time"), first, last)
    billed = split_join(
        bill_details, bills.where(period).select("bill_code"), ["bill_code"], "left_semi"
    )
    sold = split_join(
        order_details, orders.where(period).select("sale_order_code"), ["sale_order_code"], "left_semi"
    )
    goods = billed.select("goods_code").unionByName(sold.select("goods_code"))
    if stock is not None:
        goods = goods.unionByName(stock.select("goods_code"))
    return goods.where(F.col("goods_code").isNotNull()).distinct()


def new_batch(
    candidates: DataFrame, prices: DataFrame, products: DataFrame, batches: DataFrame,
    batch_no: str, day: dt.date, parts: int | None = None,
) -> DataFrame:
    """Batch rows for goods the batch lacks, numbered after the largest batch id.

    Goods without a price are left out; a null good in the batch table excludes nothing.
    """
    have = batches.where(F.col("batch_no") == batch_no).select("goods_code")
    goods = products.select(
        F.col("product_code").alias("goods_code"),
        "supplier_code",
        "supplier_name",
        F.col("product_name").alias("goods_name"),
    )
    rows = (
        candidates.join(have, "goods_code", "left_anti")
        .join(prices.select("goods_code", "cost_price"), "goods_code")
        .join(goods, "goods_code")
        .select(
            F.lit(batch_no).alias("batch_no"),
            "supplier_code", "supplier_name", "goods_code", "goods_name",
            F.lit(0).alias("amount"),
            "cost_price",
            F.lit(day).alias("create_time"),
        )
    )
    return surrogate_ids(rows, ["goods_code"], batches, "batch_id", parts)


def period_of(finance: DataFrame) -> DataFrame:
    """(a, b): each day with the start of its period; the first day of a financial month still
    belongs to the month before."""
    day_before = finance.select(
        F.date_add("date", 1).alias("date"), F.col("begin_date").alias("_before")
    )
    return finance.join(day_before, "date", "left").select(
        F.col("date").alias("a"),
        F.when(F.col("begin_date") == F.col("date"), F.col("_before"))
        .otherwise(F.col("begin_date"))
        .alias("b"),
    )


def batch_numbers(days: DataFrame, finance: DataFrame, prefix: str) -> DataFrame:
    """Batch number of each (a, b): the day itself on a period start, else the period start."""
    starts = finance.select(F.col("begin_date").alias("a")).distinct().withColumn(
        "_starts", F.lit(True)
    )
    start = F.when(F.col("_starts"), F.col("a")).otherwise(F.col("b"))
    return days.join(starts, "a", "left").select(
        "a", "b", F.concat(F.lit(prefix), F.date_format(start, "yyyyMMdd")).alias("bn")
    )
