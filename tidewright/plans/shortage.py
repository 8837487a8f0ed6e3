"""Shortage base: trailing sales, stock by place kind, and the wide table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import materialise

# Trailing windows in days.
WINDOWS = (60, 30, 15, 7)
# Bays counted as shop stock, shop stock with goods on their way, logistics stock.
SHELF, SHELF_AND_MOVING, DEPOT = ("NORMAL",), ("NORMAL", "ON_STORAGE"), ("NORMAL", "STORAGE")
KEYS = ["station_code", "supplier_code", "product_code"]
SALES = [f"sale_amount_{n}d" for n in WINDOWS]


def trailing_sales(changes: DataFrame, day: dt.date, sale_type: str | None = None) -> DataFrame:
    """Net sales of the last 60, 30, 15 and 7 days from one read of the longest window."""
    amount = -F.col("amount") * F.col("in_out_flag")
    since = [day - dt.timedelta(days=n - 1) for n in WINDOWS]
    sold = changes.where(
        F.col("date").between(F.lit(since[0]), F.lit(day)) & (F.col("bill_type") == "SALE")
    )
    if sale_type is not None:
        sold = sold.where(F.col("sale_type") == sale_type)
    return sold.groupBy(*KEYS).agg(
        *[F.sum(F.when(F.col("date") >= F.lit(d), amount)).alias(n) for d, n in zip(since, SALES)]
    )


def stock_bases(daily: DataFrame, stations: DataFrame, day: dt.date) -> DataFrame:
    """Shop stock, shop stock with goods on their way and logistics stock, one read of the day."""
    kind = F.col("category_code")

    def of(place: str, bays: tuple[str, ...]) -> F.Column:
        return F.sum(F.when((kind == place) & F.col("storage").isin(*bays), F.col("_amount")))

    place = stations.select(F.col("new_station_code").alias("station_code"), "category_code")
    return (
        daily.where((F.col("date") == F.lit(day)) & (F.col("amount") != 0))
        .groupBy(*KEYS, "storage")
        .agg(F.sum("amount").alias("_amount"))
        .join(place, "station_code")
        .groupBy(*KEYS)
        .agg(
            of("BOOKSTORE", SHELF).alias("stock_amount_normal"),
            of("BOOKSTORE", SHELF_AND_MOVING).alias("stock_amount_normal_storage"),
            of("LOGISTICS", DEPOT).alias("stock_amount_logis"),
        )
    )


def shortage_wide(
    sales: DataFrame, bases: DataFrame, stations: DataFrame, products: DataFrame,
    suppliers: DataFrame, day: dt.date,
) -> DataFrame:
    """Trailing sales and stock per station, supplier and product, with station counts and the
    stock of the logistics station that serves the shop.

    Both inputs are read several times, so each is written once instead of being computed again
    from the change and stock tables.
    """
    sales, bases = materialise(sales, "trailing-sales"), materialise(bases, "stock-bases")
    measures = [*SALES, "stock_amount_normal", "stock_amount_normal_storage"]
    # A stock row of another kind of place or bay makes no line of its own.
    useful = bases.where(
        F.coalesce("stock_amount_normal_storage", "stock_amount_logis").isNotNull()
    )
    both = sales.unionByName(useful, allowMissingColumns=True)
    merged = both.groupBy(*KEYS).agg(
        *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    )
    place = stations.select(
        F.col("new_station_code").alias("station_code"),
        F.col("new_station_name").alias("station_name"),
        "station_region_name",
        "logistic_code",
        "logistics_name",
        F.col("category_name").alias("station_type"),
    )
    depot = bases.where(F.col("stock_amount_logis").isNotNull()).select(
        F.col("station_code").alias("logistic_code"), "supplier_code", "product_code",
        "stock_amount_logis",
    )
    goods_keys = ["supplier_code", "product_code"]
    recent = sales.where(F.col("sale_amount_30d").isNotNull()).select(*KEYS)
    selling = recent.groupBy(*goods_keys).agg(
        F.count("station_code").alias("sale_station_count")
    )
    holding = (
        recent.unionByName(
            bases.where(F.col("stock_amount_normal_storage").isNotNull()).select(*KEYS)
        )
        .distinct()
        .join(place.select("station_code", "logistic_code"), "station_code")
        .groupBy(*goods_keys, "logistic_code")
        .agg(F.count("station_code").alias("exist_station_count"))
    )
    goods = products.select(
        "product_code", "product_name", "product_isbn", "product_price", "category_two_name"
    )
    return (
        merged.join(place, "station_code")
        .join(depot, ["logistic_code", *goods_keys], "left")
        .join(selling, goods_keys, "left")
        .join(holding, ["logistic_code", *goods_keys], "left")
        .join(goods, "product_code")
        .join(suppliers.select("supplier_code", "supplier_name"), "supplier_code", "left")
        .withColumn("stock_amount_logis", F.coalesce("stock_amount_logis", F.lit(0)))
        .withColumn("date", F.lit(day))
        .drop("logistic_code")
    )
