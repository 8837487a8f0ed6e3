"""Movement ledger: documents and sales turned into signed stock movements, and stock from them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import order_sign
from ..functions.dates import on_days
from ..operators.skew import split_join

Day = dt.date | None
STOCK_KEYS = ("batch_no", "goods_code", "location_code", "storage")
# Fixed value: part of the list price a bookstore pays.
FLOW_RATE = "0.62"

# Fixed values, one line per document type: (OUT row, IN row, keeps the other station as target,
# price rule).  "own" types carry their direction in the document itself.  A price rule names the
# station whose flow class decides, or the document's discounted price.
RULES = {
    "ADJUST": ("out", "in", True, "both"),
    "ALLOT": ("out", "in", True, "out"),
    "DELIVERY": ("out", "in", True, "in"),
    "RESTOCK": ("out", "in", True, "out"),
    "PICKING_MISTAKE": ("own", "own", False, "own"),
    "PRESENT": ("own", "own", False, "discount"),
    "BATCH_SALE": ("own", "own", False, "discount"),
    "PURCHASE": (None, "in", False, "discount"),
    "RETURNED": ("out", None, False, "discount"),
}
# These two keep the direction written in the document and need a station on their side.
ONE_SIDED = ("PURCHASE", "RETURNED")
# These are valued at the batch cost and exist only for goods of the current batch.
NEEDS_BATCH = ("ADJUST", "ALLOT", "DELIVERY", "RESTOCK", "PICKING_MISTAKE", "PRESENT")


def _types(test) -> list[str]:
    return [name for name, rule in RULES.items() if test(rule)]


def movements(
    bills: DataFrame, bill_details: DataFrame, stations: DataFrame, batches: DataFrame,
    batch_no: str, first: Day = None, last: Day = None,
) -> DataFrame:
    """Ledger rows of the nine bill types: one rule table instead of one query per type."""
    wanted = bills.where(
        on_days(F.col("create_time"), first, last) & F.col("bill_type").isin(*RULES)
    )
    current = (
        batches.where(F.col("batch_no") == batch_no)
        .groupBy("goods_code")
        .agg(F.min("cost_price").alias("batch_cost"))
    )

    def side(name: str) -> DataFrame:
        place = F.struct(
            F.col("new_station_code").alias("code"),
            F.col("new_station_name").alias("name"),
            F.col("category_code").alias("type"),
            F.col("category_code_flow").alias("flow"),
            F.col("erp_date").alias("erp_date"),
        )
        return stations.select(
            F.col("new_station_code").alias(f"{name}_station_code"), place.alias(f"_{name}")
        )

    # Stations are known per document, so they join the documents and not the lines.
    placed = split_join(wanted, side("in"), ["in_station_code"], "left")
    placed = split_join(placed, side("out"), ["out_station_code"], "left", keys_of=wanted)
    rows = split_join(bill_details, placed, ["bill_code"])
    rows = split_join(rows, current, ["goods_code"], "left", keys_of=bill_details)
    kind = F.col("bill_type")
    # Stations already moved to the other system report their documents there.
    moved = F.coalesce(F.col("_in.erp_date"), F.col("_out.erp_date"))
    moved = F.when(kind == "PURCHASE", F.col("_in.erp_date")).when(
        kind == "RETURNED", F.col("_out.erp_date")
    ).otherwise(moved)
    rows = rows.where(
        (moved > F.to_date("create_time"))
        & (~kind.isin(*NEEDS_BATCH) | F.col("batch_cost").isNotNull())
    )
    both = kind.isin(*_types(lambda r: r[0] == "out" and r[1] == "in"))
    own = F.col("bill_purpose")
    directions = F.when(
        both, F.array(F.lit("OUT_STORAGE"), F.lit("IN_STORAGE"))
    ).otherwise(F.array(own))
    out = rows.withColumn("_purpose", F.explode(directions))
    leaving = F.col("_purpose") == "OUT_STORAGE"
    # Purchases and returns stand on a fixed side whatever direction they carry.
    at_out = (
        F.when(kind == "PURCHASE", F.lit(False))
        .when(kind == "RETURNED", F.lit(True))
        .otherwise(leaving)
    )
    has_target = kind.isin(*_types(lambda r: r[2]))

    def place(here: bool, part: str) -> Column:
        a, b = ("_out", "_in") if here else ("_in", "_out")
        return F.when(at_out, F.col(f"{a}.{part}")).otherwise(F.col(f"{b}.{part}"))

    def bay(here: bool) -> Column:
        a, b = ("out", "in") if here else ("in", "out")
        return F.when(at_out, F.col(f"{a}_storage_code")).otherwise(F.col(f"{b}_storage_code"))

    list_price = (F.col("price") * F.lit(FLOW_RATE).cast("decimal(3,2)")).cast("decimal(18,4)")
    cost = F.col("batch_cost").cast("decimal(18,4)")
    reduced = (F.col("price") * F.col("discount")).cast("decimal(18,4)")

    def by_flow(flow: Column) -> Column:
        return F.when(flow == "BOOKSTORE", list_price).when(flow == "LOGISTICS", cost)

    def ruled(name: str) -> Column:
        return kind.isin(*_types(lambda r: r[3] == name))

    logistics = (F.col("_in.flow") == "LOGISTICS") & (F.col("_out.flow") == "LOGISTICS")
    price = (
        F.when(ruled("discount"), reduced)
        .when(ruled("both"), F.when(logistics, cost).otherwise(list_price))
        .when(ruled("in"), by_flow(F.col("_in.flow")))
        .when(ruled("out"), by_flow(F.col("_out.flow")))
        .otherwise(by_flow(place(True, "flow")))
    )
    inflow = F.when(kind == "PURCHASE", True).when(kind == "RETURNED", False).otherwise(~leaving)
    return out.select(
        F.lit(batch_no).alias("batch_no"),
        "bill_code",
        "bill_type",
        F.col("_purpose").alias("bill_purpose"),
        place(True, "code").alias("from_location_code"),
        place(True, "name").alias("from_location_name"),
        place(True, "type").alias("from_location_type"),
        bay(True).alias("from_location_storage"),
        F.when(has_target, place(False, "code")).alias("target_location_code"),
        F.when(has_target, place(False, "name")).alias("target_location_name"),
        F.when(has_target, place(False, "type")).alias("target_location_type"),
        F.when(has_target, bay(False)).alias("target_location_storage"),
        "goods_code",
        F.abs("actual_total_amount").alias("amount"),
        F.when(inflow, price).alias("inflow_price"),
        F.when(~inflow, price).alias("outflow_price"),
        "create_time",
        "update_time",
        "stock_date",
        F.lit("BI").alias("origin_bill_type"),
        F.col("id").alias("origin_bill_id"),
    )


def sale_movements(
    orders: DataFrame, details: DataFrame, stations: DataFrame, batch_no: str,
    first: Day = None, last: Day = None,
) -> DataFrame:
    """Ledger rows of retail orders: an order leaves the shelf, a back order returns to it."""
    wanted = orders.where(on_days(F.col("create_time"), first, last))
    shops = stations.select(
        F.col("new_station_code").alias("station_code"),
        "new_station_name", "category_code", "erp_date",
    )
    leaving = F.col("sale_order_type") == "ORDER"
    price = F.col("sale_real_price").cast("decimal(18,4)")
    missing = F.lit(None).cast("string")
    placed = split_join(wanted, shops, ["station_code"]).where(
        F.col("erp_date") > F.to_date("create_time")
    )
    return (
        split_join(details, placed, ["sale_order_code"])
        .select(
            F.lit(batch_no).alias("batch_no"),
            F.col("sale_order_code").alias("bill_code"),
            F.lit("SALE").alias("bill_type"),
            F.when(leaving, "OUT_STORAGE").otherwise("IN_STORAGE").alias("bill_purpose"),
            F.col("station_code").alias("from_location_code"),
            F.col("new_station_name").alias("from_location_name"),
            F.col("category_code").alias("from_location_type"),
            F.col("storage_code").alias("from_location_storage"),
            F.lit(None).cast(shops.schema["station_code"].dataType).alias("target_location_code"),
            missing.alias("target_location_name"),
            missing.alias("target_location_type"),
            missing.alias("target_location_storage"),
            "goods_code",
            F.abs("sale_amount").alias("amount"),
            F.when(F.col("sale_order_type") == "BACK_ORDER", price).alias("inflow_price"),
            F.when(leaving, price).alias("outflow_price"),
            "create_time",
            "update_time",
            F.col("create_time").alias("stock_date"),
            F.lit("SO").alias("origin_bill_type"),
            F.col("id").alias("origin_bill_id"),
        )
    )


def ledger(bill_rows: DataFrame, sale_rows: DataFrame) -> DataFrame:
    return bill_rows.unionByName(sale_rows)


def _flow_price(flow: Column, price: Column, cost: Column) -> Column:
    return F.when(
        flow == "BOOKSTORE", (price * F.lit(FLOW_RATE).cast("decimal(3,2)")).cast("decimal(18,4)")
    ).when(flow == "LOGISTICS", cost.cast("decimal(18,4)"))


def _priced(rows: DataFrame, stations: DataFrame, products: DataFrame, batches: DataFrame,
            batch_no: str) -> DataFrame:
    """Rows at known stations and for goods of the batch, with list and flow price."""
    place = stations.select(
        F.col("new_station_code").alias("location_code"),
        F.col("new_station_name").alias("location_name"),
        "category_code_flow",
    )
    goods = products.select(F.col("product_code").alias("goods_code"), "product_price")
    cost = batches.where(F.col("batch_no") == batch_no).select("goods_code", "cost_price")
    return (
        rows.join(place, "location_code")
        .join(goods, "goods_code")
        .join(cost, "goods_code")
        .withColumn("price", F.col("product_price"))
        .withColumn(
            "flow_price",
            _flow_price(F.col("category_code_flow"), F.col("product_price"), F.col("cost_price")),
        )
        .drop("category_code_flow", "product_price", "cost_price")
    )


def stock_of_batch(
    stock_details: DataFrame, movement_rows: DataFrame, stations: DataFrame, products: DataFrame,
    batches: DataFrame, batch_no: str, day: dt.date, legacy: str = "YH",
) -> DataFrame:
    """Stock rows of the current batch: counted stock, and zero rows for places that only moved."""
    keys = ["location_code", "storage", "goods_code"]
    counted = stock_details.where("amount > 0").select(
        F.col("station_code").alias("location_code"),
        F.col("storage_code").alias("storage"),
        "goods_code",
        F.col("amount").alias("total_amount"),
    ).groupBy(*keys).agg(F.sum("total_amount").alias("total_amount"))
    counted = _priced(
        counted,
        stations.where(F.col("bookstore_system") == legacy),
        products, batches, batch_no,
    )
    moved = (
        movement_rows.where(
            on_days(F.col("create_time"), day, day) & (F.col("batch_no") == batch_no)
        )
        .select(
            F.col("from_location_code").alias("location_code"),
            F.col("from_location_storage").alias("storage"),
            "goods_code",
        )
        .distinct()
    )
    moved = _priced(moved, stations, products, batches, batch_no).withColumn(
        "total_amount", F.lit(0)
    )
    return (
        counted.unionByName(moved)
        .groupBy(*keys, "location_name")
        .agg(
            F.sum("total_amount").alias("total_amount"),
            F.max("price").alias("price"),
            F.max("flow_price").alias("flow_price"),
        )
        .select(
            F.lit(batch_no).alias("batch_no"),
            "location_code", "location_name", "storage", "goods_code",
            "total_amount",
            F.col("total_amount").alias("available_amount"),
            F.lit(0).alias("used_amount"),
            "price", "flow_price",
            F.lit(day).alias("create_time"),
        )
    )


def zeroed_old_batches(
    movement_rows: DataFrame, stations: DataFrame, products: DataFrame, batches: DataFrame,
    batch_no: str, day: dt.date,
) -> DataFrame:
    """Places of earlier batches that moved on the day, as rows with zero stock."""
    moved = (
        movement_rows.where(
            on_days(F.col("create_time"), day, day) & (F.col("batch_no") != batch_no)
        )
        .select(
            F.col("batch_no").alias("old_batch"),
            F.col("from_location_code").alias("location_code"),
            F.col("from_location_storage").alias("storage"),
            "goods_code",
        )
        .distinct()
    )
    zero = F.lit(0)
    return _priced(moved, stations, products, batches, batch_no).select(
        F.col("old_batch").alias("batch_no"),
        "location_code", "location_name", "storage", "goods_code",
        zero.alias("total_amount"), zero.alias("available_amount"), zero.alias("used_amount"),
        "price", "flow_price",
        F.lit(day).alias("create_time"),
    )


def stock_rebuilt(
    calibrated: DataFrame, bills: DataFrame, bill_details: DataFrame, orders: DataFrame,
    order_details: DataFrame, first: Day = None, last: Day = None,
) -> DataFrame:
    """Current stock: calibrated count, plus documents in and out, minus sales."""
    period = on_days(F.col("create_time"), first, last)
    keys = ["station_code", "storage_code", "goods_code"]
    moves = split_join(bill_details, bills.where(period), ["bill_code"])
    # One read of the documents gives both sides of each move.
    sides = moves.select(
        "goods_code",
        F.inline(
            F.array(
                F.struct(
                    F.col("out_station_code").alias("station_code"),
                    F.col("out_storage_code").alias("storage_code"),
                    (-F.col("actual_total_amount")).alias("amount"),
                ),
                F.struct(
                    F.col("in_station_code").alias("station_code"),
                    F.col("in_storage_code").alias("storage_code"),
                    F.col("actual_total_amount").alias("amount"),
                ),
            )
        ),
    ).where(F.col("station_code").isNotNull())
    sold = split_join(
        order_details,
        orders.where(period).select("sale_order_code", "station_code", "sale_order_type"),
        ["sale_order_code"],
    ).select(*keys, (-F.col("sale_amount") * order_sign(F.col("sale_order_type"))).alias("amount"))
    parts = [f.select(*keys, F.col("amount").cast("decimal(18,2)").alias("amount"))
             for f in (calibrated, sides, sold)]
    return (
        parts[0].unionByName(parts[1]).unionByName(parts[2])
        .groupBy(*keys).agg(F.sum("amount").alias("amount"))
    )


