"""Supplier, wholesale, transfer and give-away marts over ledger and stock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import (
    CIRCULATION_TYPES,
    GIVE_DIRECTIONS,
    STATION_TYPES,
    SUPPLIER_DIRECTIONS,
    decode,
    signed,
    storage_sign,
)
from ..functions.dates import on_days
from ..operators.skew import split_join
from .ledger import STOCK_KEYS
from .stock import gift_reasons

Day = dt.date | None
# Fixed value: reason of a give-away that names none.
OTHER_GIFT = "其他赠送"


def _batch(batches: DataFrame, *columns: str) -> DataFrame:
    return batches.select("batch_no", "goods_code", *columns)


def _goods(products: DataFrame, *columns: str) -> DataFrame:
    return products.select(F.col("product_code").alias("goods_code"), *columns)


def station_circulation(
    ledger: DataFrame, batches: DataFrame, products: DataFrame, first: Day = None, last: Day = None
) -> DataFrame:
    """Transfers between stations, one row per outgoing ledger row."""
    moved = ledger.where(
        on_days(F.col("create_time"), first, last)
        & F.col("bill_type").isin(*CIRCULATION_TYPES)
        & (F.col("bill_purpose") == "OUT_STORAGE")
    )
    amount = F.col("amount")
    goods = _goods(products, "product_name", "product_isbn", "product_price",
                   "fina_category_code", "fina_category_name")
    rows = split_join(moved, _batch(batches, "cost_price"), ["batch_no", "goods_code"])
    return (
        split_join(rows, goods, ["goods_code"], keys_of=moved)
        .select(
            F.to_date("create_time").alias("create_time"),
            "bill_code",
            decode(F.col("bill_type"), CIRCULATION_TYPES).alias("bill_type_name"),
            "from_location_code",
            "from_location_name",
            decode(F.col("from_location_type"), STATION_TYPES).alias("from_station_type_name"),
            "target_location_code",
            "target_location_name",
            decode(F.col("target_location_type"), STATION_TYPES).alias("target_station_type_name"),
            "goods_code", "product_name", "product_isbn", "product_price",
            "fina_category_code", "fina_category_name",
            "amount",
            (amount * F.col("product_price")).alias("total_price"),
            (amount * F.coalesce("inflow_price", "outflow_price")).alias("distribution_price"),
            (amount * F.col("cost_price")).alias("stock_price"),
        )
    )


def supplier_in_out(
    ledger: DataFrame, batches: DataFrame, products: DataFrame, first: Day = None, last: Day = None
) -> DataFrame:
    """Purchases and returns side by side per day, supplier, category and logistics station."""
    amount = F.col("amount")

    def of(kind: str, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(F.col("bill_type") == kind, value)), F.lit(0))

    keys = ["create_date", "batch_no", "goods_code", "from_location_code", "from_location_name"]
    moved = (
        ledger.where(
            on_days(F.col("create_time"), first, last)
            & F.col("bill_type").isin("PURCHASE", "RETURNED")
        )
        .groupBy(F.to_date("create_time").alias("create_date"), *keys[1:])
        .agg(
            of("PURCHASE", amount).alias("_bought"),
            of("RETURNED", amount).alias("_returned"),
        )
    )
    bought, returned = F.col("_bought"), F.col("_returned")
    price, cost = F.col("product_price"), F.col("cost_price")
    return (
        moved.join(_batch(batches, "supplier_code", "supplier_name", "cost_price"),
                   ["batch_no", "goods_code"])
        .join(_goods(products, "category_two_code", "category_two_name", "product_state",
                     "product_price"), "goods_code")
        .groupBy(
            F.col("create_date").alias("create_time"), "supplier_code", "supplier_name",
            "category_two_code", "category_two_name", "from_location_code", "from_location_name",
            "product_state",
        )
        .agg(
            F.sum(bought).alias("in_amount"),
            F.sum(bought * price).alias("in_total_product"),
            F.sum(bought * cost).alias("in_cost"),
            F.sum(returned).alias("out_amount"),
            F.sum(returned * price).alias("out_total_product"),
            F.sum(returned * cost).alias("out_cost"),
        )
    )


def supplier_reconciliation(
    ledger: DataFrame, batches: DataFrame, products: DataFrame, first: Day = None, last: Day = None
) -> DataFrame:
    """Purchase and return documents, one signed row per ledger row."""
    moved = ledger.where(
        on_days(F.col("create_time"), first, last)
        & F.col("bill_type").isin("PURCHASE", "RETURNED")
    )
    purpose = F.col("bill_purpose")
    amount = F.col("amount") * signed(purpose, ["IN_STORAGE"], ["OUT_STORAGE"], None)
    goods = _goods(products, "product_name", "product_isbn", "product_price",
                   "fina_category_code", "fina_category_name")
    rows = split_join(moved, _batch(batches, "supplier_code", "supplier_name"),
                      ["batch_no", "goods_code"])
    return (
        split_join(rows, goods, ["goods_code"], keys_of=moved)
        .select(
            F.to_date("create_time").alias("create_time"),
            "bill_code",
            decode(purpose, SUPPLIER_DIRECTIONS).alias("bill_type_name"),
            "supplier_code", "supplier_name", "from_location_code", "from_location_name",
            decode(F.col("from_location_type"), STATION_TYPES).alias("station_type_name"),
            "goods_code", "product_name", "product_isbn", "product_price",
            "fina_category_code", "fina_category_name",
            amount.alias("amount"),
            (amount * F.col("product_price")).alias("total_price"),
            (amount * F.coalesce("inflow_price", "outflow_price")).alias("stock_price"),
        )
    )


def supplier_sale(
    changes: DataFrame, products: DataFrame, stations: DataFrame, first: Day = None,
    last: Day = None,
) -> DataFrame:
    """Retail and wholesale amounts per day, category, station, supplier and product state."""
    amount = F.col("amount")
    sold = (
        changes.where(
            on_days(F.col("create_time"), first, last)
            & F.col("bill_type").isin("SALE", "BATCH_SALE")
        )
        .groupBy(F.to_date("create_time").alias("create_date"), "station_code", "product_code")
        .agg(
            F.sum(amount).alias("_amount"),
            F.sum(amount * F.col("price")).alias("_price"),
            F.sum(amount * F.col("cost_price")).alias("_cost"),
        )
    )
    goods = products.select(
        "product_code", "category_two_name", "supplier_code", "supplier_name", "product_state"
    )
    return (
        sold.join(goods, "product_code")
        .join(
            stations.select("new_station_code"),
            F.col("station_code") == F.col("new_station_code"),
        )
        .groupBy(
            F.col("create_date").alias("create_time"), "category_two_name", "new_station_code",
            "supplier_code", "supplier_name", "product_state",
        )
        .agg(
            (-F.sum("_amount")).alias("sale_amount"),
            (-F.sum("_price")).alias("sale_product_price"),
            (-F.sum("_cost")).alias("sale_cost_price"),
        )
    )


def supplier_stock(
    daily: DataFrame, products: DataFrame, stations: DataFrame, suppliers: DataFrame
) -> DataFrame:
    """Stock per day, category, supplier and logistics station; products netting to zero drop out."""
    keys = [
        "date", "category_two_name", "supplier_code", "product_state", "logistic_code",
        "logistic_name",
    ]
    amount = F.col("amount")
    # Collapse per station first; the dimensions then meet one row per day, station and product.
    per_station = daily.groupBy("date", "station_code", "supplier_code", "product_code").agg(
        F.sum(amount).alias("_amount"),
        F.sum(amount * F.col("price")).alias("_total"),
        F.sum(amount * F.col("cost_price")).alias("_cost"),
    )
    place = stations.select(
        F.col("new_station_code").alias("station_code"),
        "logistic_code",
        F.col("logistics_name").alias("logistic_name"),
    )
    per_product = (
        per_station.join(place, "station_code")
        .join(products.select("product_code", "category_two_name", "product_state"), "product_code")
        .groupBy(*keys, "product_code")
        .agg(
            F.sum("_amount").alias("stock_amount"),
            F.sum("_total").alias("stock_total_price"),
            F.sum("_cost").alias("stock_real_price"),
        )
        .where(F.col("stock_amount") != 0)
    )
    return (
        per_product.groupBy(*keys)
        .agg(
            *[F.sum(m).alias(m) for m in ("stock_amount", "stock_total_price", "stock_real_price")],
            F.count("product_code").alias("goods_code_amount"),
        )
        .join(suppliers.select("supplier_code", "supplier_name"), "supplier_code", "left")
        .withColumnRenamed("date", "create_time")
    )


def supplier_stock_now(
    stock: DataFrame, products: DataFrame, stations: DataFrame, batches: DataFrame, day: dt.date
) -> DataFrame:
    """The older form: current stock, valued at list price and at batch cost."""
    amount = F.col("available_amount")
    place = stations.select(
        F.col("new_station_code").alias("location_code"),
        "logistic_code",
        F.col("logistics_name").alias("logistic_name"),
    )
    per_place = stock.groupBy("batch_no", "goods_code", "location_code").agg(
        F.sum(amount).alias("_amount")
    )
    keys = [
        "category_two_name", "supplier_code", "supplier_name", "product_state", "logistic_code",
        "logistic_name",
    ]
    return (
        per_place.join(place, "location_code")
        .join(_goods(products, "category_two_name", "supplier_code", "supplier_name",
                     "product_state", "product_price"), "goods_code")
        .join(_batch(batches, "cost_price"), ["batch_no", "goods_code"])
        .groupBy(*keys, "goods_code")
        .agg(
            F.sum("_amount").alias("_amount"),
            F.sum(F.col("_amount") * F.col("product_price")).alias("_total"),
            F.sum(F.col("_amount") * F.col("cost_price")).alias("_cost"),
        )
        .groupBy(*keys)
        .agg(
            F.sum("_amount").alias("stock_amount"),
            F.sum("_total").alias("stock_total_price"),
            F.sum("_cost").alias("stock_real_price"),
            F.count("goods_code").alias("goods_code_amount"),
        )
        .withColumn("create_time", F.lit(day))
    )


def wholesale(
    ledger: DataFrame, batches: DataFrame, stock: DataFrame, products: DataFrame,
    first: Day = None, last: Day = None,
) -> DataFrame:
    """Wholesale money and cost per day, station and finance class."""
    amount = F.col("amount") * -storage_sign(F.col("bill_purpose"))
    sums = (
        ledger.where(
            on_days(F.col("create_time"), first, last) & (F.col("bill_type") == "BATCH_SALE")
        )
        .groupBy(
            F.to_date("create_time").alias("create_date"),
            "batch_no", "goods_code",
            F.col("from_location_code").alias("location_code"),
            F.col("from_location_storage").alias("storage"),
            "from_location_name", "from_location_type",
        )
        .agg(
            F.sum(amount).alias("_amount"),
            F.sum(amount * F.coalesce("inflow_price", "outflow_price")).alias("_money"),
        )
    )
    n = F.col("_amount")
    return (
        sums.join(stock.select(*STOCK_KEYS, "flow_price"), list(STOCK_KEYS))
        .join(_batch(batches, "cost_price"), ["batch_no", "goods_code"])
        .join(_goods(products, "product_price", "fina_category_code", "fina_category_name"),
              "goods_code")
        .groupBy(
            F.col("create_date").alias("create_time"),
            F.col("location_code").alias("from_location_code"),
            "from_location_name",
            decode(F.col("from_location_type"), STATION_TYPES).alias("station_type_name"),
            "fina_category_code", "fina_category_name",
        )
        .agg(
            F.sum(n * F.col("product_price")).alias("wholesale_real_price"),
            F.sum("_money").alias("wholesale_total_price"),
            F.sum(n * F.col("flow_price")).alias("distribution_price"),
            F.sum(n * F.col("cost_price")).alias("stock_price"),
        )
    )


def give_aways(
    changes: DataFrame, stations: DataFrame, products: DataFrame, gifts: DataFrame,
    first: Day = None, last: Day = None, keys_of: DataFrame | None = None,
) -> DataFrame:
    """Give-aways per day, reason, direction, station and finance class in four valuations.

    ``keys_of`` (offset_bill_code) is the scan behind ``changes``, to count hot documents on.
    """
    keep = F.col("bill_type") == "PRESENT"
    if first is not None:
        keep = keep & (F.col("date") >= F.lit(first))
    if last is not None:
        keep = keep & (F.col("date") <= F.lit(last))
    flag = F.col("in_out_flag")
    amount = F.col("amount") * flag * flag
    reasons = gift_reasons(gifts).withColumnRenamed("code", "offset_bill_code")
    sums = (
        split_join(changes.where(keep), reasons, ["offset_bill_code"], "left", keys_of=keys_of)
        .groupBy(
            "date",
            F.coalesce("present_reason", F.lit(OTHER_GIFT)).alias("discount_reasons"),
            decode(flag, GIVE_DIRECTIONS).alias("bill_purpose_name"),
            "station_code",
            "product_code",
        )
        .agg(
            F.sum(amount * F.col("price")).alias("_give_real"),
            F.sum(amount * F.col("real_price")).alias("_give_total"),
            F.sum(amount * F.col("flow_price")).alias("_distribution"),
            F.sum(amount * F.col("cost_price")).alias("_stock"),
        )
    )
    place = stations.select(
        F.col("new_station_code").alias("station_code"),
        F.col("new_station_name").alias("from_location_name"),
        decode(F.col("category_code"), STATION_TYPES).alias("station_type_name"),
    )
    return (
        sums.join(place, "station_code")
        .join(products.select("product_code", "fina_category_code", "fina_category_name"),
              "product_code")
        .groupBy(
            F.col("date").alias("create_time"), "discount_reasons", "bill_purpose_name",
            F.col("station_code").alias("from_location_code"), "from_location_name",
            "station_type_name", "fina_category_code", "fina_category_name",
        )
        .agg(
            F.sum("_give_real").alias("give_real_price"),
            F.sum("_give_total").alias("give_total_price"),
            F.sum("_distribution").alias("distribution_price"),
            F.sum("_stock").alias("stock_price"),
        )
    )
