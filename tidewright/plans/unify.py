"""One set of order, detail, payment and wholesale facts from two source systems."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import (
    DEFAULT_SALE_TYPE,
    DEFAULT_SALE_TYPE_NAME,
    SALE_TYPE_NAMES,
    SALE_TYPES,
    by_prefix,
    order_sign,
)
from ..operators.incremental import align, newer_than, newer_than_per_source, translate_codes
from ..operators.skew import split_join

MEMBER, NO_MEMBER = "会员", "非会员"
# Origins and the states the second system's rows must have.
CENTER, ERP, LEGACY = "DC", "ERP", "YH"

ORDER_TYPES = {
    "sale_order_id": "bigint", "sale_order_code": "bigint", "member_code": "bigint",
    "station_code": "bigint", "total_amount": "decimal(18,2)", "total_money": "decimal(18,2)",
    "real_money": "decimal(18,2)", "memo": "string", "sale_order_state": "string",
    "source_code": "string", "new_operator_code": "string", "create_time": "timestamp_ntz",
    "sale_type": "string", "sale_type_name": "string", "sale_order_type": "string",
    "in_out_flag": "int", "member_type": "string", "batch_code": "string",
    "origin_system": "string",
}
DETAIL_TYPES = {
    "id": "bigint", "sale_order_code": "bigint", "product_code": "bigint",
    "product_name": "string", "product_type": "string", "sale_amount": "decimal(18,2)",
    "return_amount": "decimal(18,2)", "sale_discount": "decimal(6,4)",
    "sale_price": "decimal(18,2)", "sale_real_price": "decimal(18,4)",
    "sale_real_money": "decimal(30,6)", "sale_money": "decimal(30,4)", "sale_order_id": "bigint",
    "origin_system": "string",
}
PAYMENT_TYPES = {
    "id": "bigint", "sale_order_code": "bigint", "balance": "decimal(18,2)",
    "pay_method_code": "bigint", "pay_method_name": "string", "pay_money": "decimal(18,2)",
    "actual_money": "decimal(18,2)", "pay_date": "timestamp_ntz", "sale_order_id": "bigint",
    "origin_system": "string",
}


def _columns(types: dict, **given) -> dict:
    """Source column of the same name unless given; None gives a typed null."""
    return {name: given[name] if name in given else F.col(name) for name in types}


def _member_type():
    return F.when(F.col("member_code").isNull(), NO_MEMBER).otherwise(MEMBER)


def _legacy_stations(stations: DataFrame) -> DataFrame:
    return stations.where(F.col("bookstore_system") == LEGACY).select(
        F.col("new_station_code").alias("station_code")
    )


def unified_orders(center: DataFrame, erp: DataFrame, stations: DataFrame) -> DataFrame:
    """Orders of legacy stations from the data center, finished orders of the others from ERP.

    The data center names its sale channel only in the memo text.
    """
    memo = F.col("memo")
    a = align(
        split_join(center, _legacy_stations(stations), ["station_code"], "left_semi"),
        _columns(
            ORDER_TYPES,
            sale_order_id=F.col("id"),
            sale_order_state=F.lit("DONE"),
            source_code=None,
            new_operator_code=F.col("operator_code"),
            sale_type=by_prefix(memo, SALE_TYPES, DEFAULT_SALE_TYPE),
            sale_type_name=by_prefix(memo, SALE_TYPE_NAMES, DEFAULT_SALE_TYPE_NAME),
            in_out_flag=order_sign(F.col("sale_order_type")),
            member_type=_member_type(),
            batch_code=None,
        ),
        ORDER_TYPES,
    )
    b = align(
        erp.where((F.col("sale_order_state") == "DONE") & (F.col("source") != LEGACY)),
        _columns(
            ORDER_TYPES,
            sale_order_id=F.col("id"),
            in_out_flag=order_sign(F.col("sale_order_type")),
            member_type=_member_type(),
            origin_system=F.lit(ERP),
        ),
        ORDER_TYPES,
    )
    return a.unionByName(b)


def _center_orders(orders: DataFrame, stations: DataFrame, since: dt.date) -> DataFrame:
    fresh = orders.where(
        (F.col("origin_system") == CENTER)
        & (F.col("create_time") >= F.lit(since).cast("timestamp_ntz"))
    )
    return split_join(fresh, _legacy_stations(stations), ["station_code"], "left_semi").select(
        "sale_order_code", F.col("id").alias("sale_order_id"), "create_time"
    )


def _erp_orders(orders: DataFrame) -> DataFrame:
    return orders.where(
        (F.col("sale_order_state") == "DONE") & (F.col("source") != LEGACY)
    ).select("sale_order_code", F.col("id").alias("sale_order_id"))


def _fresh(rows: DataFrame, target: DataFrame, origin: str) -> DataFrame:
    """Rows past the mark of one origin; the mark reaches the scan as a filter."""
    return newer_than(rows, target.where(F.col("origin_system") == origin), "id")


def unified_details(
    center: DataFrame, center_orders: DataFrame, erp: DataFrame, erp_orders: DataFrame,
    stations: DataFrame, target: DataFrame, since: dt.date,
) -> DataFrame:
    """Order lines newer than what each origin has already delivered to ``target``."""
    fresh = _fresh(center.where(F.col("origin_system") == CENTER), target, CENTER)
    money = F.col("sale_amount") * F.col("sale_price")
    a = align(
        split_join(fresh, _center_orders(center_orders, stations, since), ["sale_order_code"]),
        _columns(
            DETAIL_TYPES,
            product_code=F.col("goods_code"),
            product_name=None,
            product_type=F.lit("SALE_SELL"),
            return_amount=None,
            sale_real_money=money * F.col("sale_discount"),
            sale_money=money,
        ),
        DETAIL_TYPES,
    )
    fresh = _fresh(erp, target, ERP).withColumn("origin_system", F.lit(ERP))
    b = align(
        split_join(fresh, _erp_orders(erp_orders), ["sale_order_code"]),
        _columns(DETAIL_TYPES),
        DETAIL_TYPES,
    )
    return a.unionByName(b)


def unified_payments(
    center: DataFrame, center_orders: DataFrame, erp: DataFrame, erp_orders: DataFrame,
    stations: DataFrame, target: DataFrame, since: dt.date,
) -> DataFrame:
    """Payments of both systems; the data center knows one money amount, ERP two."""
    fresh = _fresh(center.where(F.col("origin_system") == CENTER), target, CENTER)
    a = align(
        split_join(fresh, _center_orders(center_orders, stations, since), ["sale_order_code"]),
        _columns(
            PAYMENT_TYPES,
            balance=None,
            pay_method_name=None,
            actual_money=F.col("pay_money"),
            pay_date=F.col("create_time"),
        ),
        PAYMENT_TYPES,
    )
    fresh = _fresh(erp, target, ERP).withColumn("origin_system", F.lit(ERP))
    b = align(
        split_join(fresh, _erp_orders(erp_orders), ["sale_order_code"]),
        _columns(PAYMENT_TYPES, pay_money=F.abs("pay_money")),
        PAYMENT_TYPES,
    )
    return a.unionByName(b)


def unified_wholesale(
    parts: list[tuple[DataFrame, str, str]], target: DataFrame, key: str = "id"
) -> DataFrame:
    """Wholesale documents of several tables, each tagged with its type and origin, newer than
    the target's mark for that type, purpose and origin."""
    out = None
    for rows, kind, origin in parts:
        loaded = target.where(
            (F.col("origin_system") == origin) & (F.col("origin_bill_type") == kind)
        )
        fresh = newer_than_per_source(rows, loaded, key, ["bill_type"]).withColumns(
            {"origin_bill_type": F.lit(kind), "origin_system": F.lit(origin)}
        )
        out = fresh if out is None else out.unionByName(fresh, allowMissingColumns=True)
    return out


# Fixed value: member codes holding this word stand for no member.
RETAIL = "RETAIL"


def cleaned(
    rows: DataFrame, names: DataFrame, codes: list[str], unsigned: list[str], origin: str
) -> DataFrame:
    """Rows with current codes, unsigned numbers and their origin."""
    return (
        translate_codes(rows, names, codes)
        .withColumns({c: F.abs(c) for c in unsigned})
        .withColumn("origin_system", F.lit(origin))
    )


def _since(rows: DataFrame, since: dt.date | None) -> DataFrame:
    if since is None:
        return rows
    return rows.where(F.col("create_time") >= F.lit(since).cast("timestamp_ntz"))


def cleaned_orders(
    orders: DataFrame, station_codes: DataFrame, since: dt.date | None = None,
    origin: str = CENTER,
) -> DataFrame:
    """Orders with current station codes and unsigned totals.

    Rows of the oldest system also lose placeholder members; its real money keeps its sign.
    """
    totals = [c for c in orders.columns if c.startswith("total_")]
    if origin != LEGACY:
        totals = [*totals, "real_money"]
    out = cleaned(_since(orders, since), station_codes, ["station_code"], totals, origin)
    if origin != LEGACY:
        return out
    return out.withColumn(
        "member_code", F.when(~F.contains("member_code", F.lit(RETAIL)), F.col("member_code"))
    )


def cleaned_order_details(
    details: DataFrame, orders: DataFrame, storage_codes: DataFrame,
    since: dt.date | None = None, origin: str = CENTER,
) -> DataFrame:
    """Order lines of the wanted orders with current storage codes and unsigned numbers."""
    unsigned = ["sale_amount", "sale_discount", "sale_price", "sale_real_price"]
    wanted = details
    if since is not None:
        fresh = _since(orders, since).select("sale_order_code")
        wanted = split_join(details, fresh, ["sale_order_code"], "left_semi")
    return cleaned(wanted, storage_codes, ["storage_code"], unsigned, origin)


def cleaned_bills(
    bills: DataFrame, station_codes: DataFrame, since: dt.date | None = None, origin: str = CENTER
) -> DataFrame:
    """Bills with current station codes and unsigned totals."""
    totals = [c for c in bills.columns if c.startswith("total_")]
    stations = [c for c in bills.columns if c.endswith("_station_code")]
    return cleaned(_since(bills, since), station_codes, stations, totals, origin)


def cleaned_bill_details(
    details: DataFrame, bills: DataFrame, storage_codes: DataFrame, since: dt.date,
    origin: str = CENTER,
) -> DataFrame:
    """Bill lines with current storage codes and unsigned numbers."""
    unsigned = ["actual_total_amount", "discount", "price", "shipped_total_amount"]
    fresh = _since(bills, since).select("bill_code")
    return cleaned(
        split_join(details, fresh, ["bill_code"], "left_semi"),
        storage_codes,
        ["in_storage_code", "out_storage_code"],
        unsigned,
        origin,
    )
