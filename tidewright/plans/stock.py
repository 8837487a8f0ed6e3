"""Stock change, stock at any day, and stock snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.codes import storage_sign
from ..functions.dates import on_days
from ..operators.skew import hot_hashes, split_join
from ..sources.bucketed import join_bucketed
from .ledger import STOCK_KEYS

Day = dt.date | None
PRODUCT_NAMES = (
    "fina_category_name", "category_two_name", "category_three_name", "category_four_name",
    "category_five_name", "product_isbn", "product_name", "product_price",
)
_AMOUNT = "decimal(18,2)"
BATCH_KEYS = ["batch_no", "goods_code"]
# Fixed value: the bay of goods on their way.
IN_TRANSIT = "ON_STORAGE"
# Fixed value: reason of goods given away with a sale.
SALE_GIFT = "零售赠送"


def _at_stock_keys(ledger: DataFrame, first: Day, last: Day) -> DataFrame:
    """Ledger rows of the wanted days at the names of the stock keys."""
    return ledger.where(on_days(F.col("create_time"), first, last)).withColumnsRenamed(
        {"from_location_code": "location_code", "from_location_storage": "storage"}
    )


def _changes(
    ledger: DataFrame, batches: DataFrame, stock: DataFrame, first: Day, last: Day, *more: Column | str
) -> DataFrame:
    """Change rows with batch cost and stock price, and what else of the ledger is wanted."""
    moved = _at_stock_keys(ledger, first, last)
    return _with_values(moved.select(*_row_columns(), *more), batches, stock, moved)


def _with_values(moved: DataFrame, batches: DataFrame, stock: DataFrame, keys_of: DataFrame) -> DataFrame:
    """Rows at stock keys with the price of their stock and the cost and supplier of their batch.

    Stock may have as many rows as the ledger, of which often only a few days or one kind are
    wanted, so stock is moved to its keys only and the rows go on to the batches.
    """
    prices = stock.select(*STOCK_KEYS, "price", "flow_price")
    priced = split_join(moved, prices, STOCK_KEYS, keys_of=keys_of)
    return split_join(priced, _costs(batches), BATCH_KEYS, keys_of=keys_of)


def _costs(batches: DataFrame) -> DataFrame:
    return batches.select(*BATCH_KEYS, "supplier_code", "cost_price")


def valued(stock: DataFrame, batches: DataFrame) -> DataFrame:
    """Stock keys with their price and the cost and supplier of their batch."""
    return stock.select(*STOCK_KEYS, "price", "flow_price").join(_costs(batches), BATCH_KEYS)


def _row_columns() -> list[Column | str]:
    """What a change row takes from the ledger, as narrow as it is moved."""
    return [
        F.to_date("create_time").alias("date"),
        *STOCK_KEYS,
        "amount",
        storage_sign(F.col("bill_purpose")).alias("in_out_flag"),
        F.coalesce("inflow_price", "outflow_price").alias("real_price"),
        "bill_type",
        F.col("bill_code").alias("offset_bill_code"),
    ]


def _change_columns() -> list[Column | str]:
    return [
        "date",
        "batch_no",
        "supplier_code",
        F.col("goods_code").alias("product_code"),
        F.col("location_code").alias("station_code"),
        "storage",
        "amount",
        "in_out_flag",
        "price",
        "real_price",
        "flow_price",
        "cost_price",
        "bill_type",
        "offset_bill_code",
    ]


def stock_change_erp(
    ledger: DataFrame, batches: DataFrame, stock: DataFrame, collected: DataFrame,
    first: Day = None, last: Day = None,
) -> DataFrame:
    """Change rows whose sale order is found through the collection document of the same day."""
    rows = _changes(ledger, batches, stock, first, last, "create_time").select(
        *_change_columns(), "create_time", F.col("create_time").alias("stock_date")
    )
    papers = collected.select(
        F.col("bill_code").alias("offset_bill_code"),
        F.to_date("create_time").alias("date"),
        F.col("order_code").alias("bill_code"),
    )
    paper_keys = ledger.where(on_days(F.col("create_time"), first, last)).select(
        F.col("bill_code").alias("offset_bill_code"), F.to_date("create_time").alias("date")
    )
    return split_join(
        rows, papers, ["offset_bill_code", "date"], "left", keys_of=paper_keys
    ).withColumn("origin_system", F.lit("ERP"))


def stock_change_center(
    ledger: DataFrame, batches: DataFrame, stock: DataFrame,
    first: Day = None, last: Day = None,
) -> DataFrame:
    """Change rows of the older system: times come from the update, the bill is its own."""
    return _changes(ledger, batches, stock, first, last, "update_time", "stock_date").select(
        *_change_columns(),
        F.col("update_time").alias("create_time"),
        "stock_date",
        F.col("offset_bill_code").alias("bill_code"),
    ).withColumn("origin_system", F.lit("YH"))


def bucketed_facts(
    ledger: DataFrame, batches: DataFrame, stock: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Ledger and valued stock as ``sources.bucketed`` stores them, on the stock keys."""
    facts = ledger.withColumnsRenamed(
        {"from_location_code": "location_code", "from_location_storage": "storage"}
    )
    return facts, valued(stock, batches)


def stock_change_bucketed(facts: DataFrame, lookup: DataFrame, first: Day = None, last: Day = None) -> DataFrame:
    """``stock_change_center`` from the two bucketed tables: the ledger is not moved."""
    moved = facts.where(on_days(F.col("create_time"), first, last))
    values = ["supplier_code", "price", "flow_price", "cost_price"]
    found = join_bucketed(moved, lookup, STOCK_KEYS).select(*_row_columns(), "update_time", "stock_date", *values)
    return found.select(
        *_change_columns(),
        F.col("update_time").alias("create_time"),
        "stock_date",
        F.col("offset_bill_code").alias("bill_code"),
    ).withColumn("origin_system", F.lit("YH"))


def stock_change_combined(
    ledger: DataFrame, batches: DataFrame, stock: DataFrame, collected: DataFrame,
    orders: DataFrame, gifts: DataFrame, center_gifts: DataFrame, gift_lines: DataFrame,
    center_gift_label: str, first: Day = None, last: Day = None,
) -> DataFrame:
    """Change rows of both systems with sale type and give-away reason.

    ``gifts`` is (code, related_bill_code, describe_des, create_time), ``center_gifts`` the bill
    codes and times of the older system, ``gift_lines`` the orders and products given away.
    """
    # Documents are found by day, so those of other days stay out of the joins.
    wanted = on_days(F.col("create_time"), first, last)
    papers = collected.where(wanted).select(
        F.col("bill_code").alias("offset_bill_code"),
        F.to_date("create_time").alias("date"),
        F.col("origin_bill_code").alias("bill_code"),
    )
    sold = orders.where(wanted).select(
        F.col("sale_order_code").alias("bill_code"),
        F.to_date("create_time").alias("date"),
        "sale_type",
    )
    own = gift_reasons(gifts).select(
        F.col("code").alias("offset_bill_code"), F.col("present_reason").alias("_own")
    )
    center = center_gifts.where(wanted).select(
        F.col("bill_code").alias("offset_bill_code"),
        F.to_date("create_time").alias("date"),
    ).distinct().withColumn("_center", F.lit(center_gift_label))
    with_sale = gift_lines.where(wanted).select(
        F.col("sale_order_code").alias("bill_code"),
        F.to_date("create_time").alias("date"),
        "product_code",
    ).groupBy("bill_code", "date").agg(F.collect_set("product_code").alias("_given"))
    # Everything known per document is put together first, also the products given away with its
    # sale, so the many ledger rows of a document meet it in one join whose hot keys can be seen in
    # the ledger.  Rows without a document drop out there, before they are moved to their stock.
    documents = (
        papers.join(sold, ["bill_code", "date"], "left")
        .join(with_sale, ["bill_code", "date"], "left")
        .join(own, "offset_bill_code", "left")
        .join(center, ["offset_bill_code", "date"], "left")
        .withColumn("_reason", F.coalesce("_own", "_center"))
        .drop("_own", "_center")
    )
    moved = _at_stock_keys(ledger, first, last)
    scanned = moved.select(
        F.col("bill_code").alias("offset_bill_code"), F.to_date("create_time").alias("date")
    )
    time = F.when(F.col("origin_system") == "YH", F.col("update_time")).otherwise(F.col("create_time"))
    given = F.when(F.array_contains("_given", F.col("goods_code")), F.lit(SALE_GIFT))
    papered = (
        split_join(
            moved.select(*_row_columns(), time.alias("create_time")),
            documents, ["offset_bill_code", "date"], keys_of=scanned,
        )
        .withColumn("present_reason", F.coalesce("_reason", given))
        .drop("_reason", "_given")
    )
    rows = _with_values(papered, batches, stock, moved).select(
        "bill_code", *_change_columns(), "create_time", "sale_type", "present_reason"
    )
    keys = ["bill_code", "date", "product_code"]
    return rows.select(*keys, *[c for c in rows.columns if c not in keys])


def gift_reasons(gifts: DataFrame) -> DataFrame:
    """(code, present_reason): a return document without a reason inherits its source's.

    Only documents that lack a reason and name a source are joined; the others, most of them with
    a null source, pass by.
    """
    source = gifts.select(
        F.col("code").alias("related_bill_code"), F.col("describe_des").alias("present_reason")
    )
    asks = F.col("describe_des").isNull() & F.col("related_bill_code").isNotNull()
    found = split_join(
        gifts.where(asks).select("code", "related_bill_code"), source, ["related_bill_code"], "left"
    )
    known = gifts.where(~asks).select("code", F.col("describe_des").alias("present_reason"))
    return known.unionByName(found.select("code", "present_reason"))


def book_stock_change(
    changes: DataFrame, products: DataFrame, storages: DataFrame, first: Day = None,
    last: Day = None, keys_of: DataFrame | None = None,
) -> DataFrame:
    """Money, amount and cost moved per day, station, bay and product.

    Rows collapse to (day, station, bay, product) before any dimension is joined, so a product
    that moves all the time meets the joins as few rows.  Where ``keys_of``, the scan the changes
    came from, has no such product, rows go straight to the task that sums and names them.
    """
    sign = -F.col("in_out_flag")
    amount = F.col("amount") * sign
    keep = F.lit(True)
    if first is not None:
        keep = keep & (F.col("date") >= F.lit(first))
    if last is not None:
        keep = keep & (F.col("date") <= F.lit(last))
    rows = changes.where(keep)
    if keys_of is not None and not hot_hashes(keys_of, ["product_code"]):
        rows = rows.repartition("product_code")
    sums = (
        rows.groupBy("date", "station_code", "storage", "product_code")
        .agg(
            F.sum(amount * F.col("price")).alias("change_money"),
            F.sum(amount).alias("change_amount"),
            F.sum(amount * F.col("flow_price")).alias("price"),
            F.sum(amount * F.col("cost_price")).alias("cost_price"),
        )
    )
    names = storages.select(
        F.col("storage_code").alias("storage"), "storage_name"
    )
    return (
        sums.join(products.select("product_code", *PRODUCT_NAMES), "product_code")
        .join(names, "storage", "left")
        .drop("storage")
        .withColumnsRenamed({"date": "create_time", "station_code": "from_location_code"})
    )


def back_rolled_stock(
    stock: DataFrame, ledger: DataFrame, batches: DataFrame, first: dt.date, last: dt.date,
    today: Day = None, by: Sequence[str] = (), stretches: bool = False,
) -> DataFrame:
    """Stock at the end of each day from ``first`` to ``last``, non-zero rows only.

    Stock of a day is the current stock with all later movements undone.  Movements collapse to
    one row per key and day; a window over those (a key has at most one row per day) gives what
    is undone from one change to the next, and each stretch is then written out day by day.  All
    days come from one read of the ledger.

    Most stock has not moved since, so the movements go to the stock, which is read once; only
    what is not zero goes on to the batches.  Columns in ``by``, which a caller groups or joins by
    afterwards, deal the stretches before they become many rows.  With ``stretches`` they are not
    written out: a row holds from ``from`` to ``to`` instead of at ``date``.
    """
    keys = list(STOCK_KEYS)
    after = last + dt.timedelta(days=1)
    upper = None if today is None else today - dt.timedelta(days=1)
    undone = F.col("amount") * -storage_sign(F.col("bill_purpose"))
    # Every key that moved also has a day after the last one, where nothing is undone yet.
    days = F.array(
        F.struct(F.least(F.to_date("create_time"), F.lit(after)).alias("_day"), undone.cast(_AMOUNT).alias("_change")),
        F.struct(F.lit(after).alias("_day"), F.lit(0).cast(_AMOUNT).alias("_change")),
    )
    changes = (
        ledger.where(on_days(F.col("create_time"), first + dt.timedelta(days=1), upper))
        .select(
            "batch_no",
            "goods_code",
            F.col("from_location_code").alias("location_code"),
            F.col("from_location_storage").alias("storage"),
            F.inline(days),
        )
        .groupBy(*keys, "_day")
        .agg(F.sum("_change").alias("_change"))
    )
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("_day"))
    so_far = newest_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Between two changes the later ones are undone; before the earliest change the stretch begins
    # with the first day asked for.
    rolled = changes.select(
        *keys,
        F.coalesce(F.lead("_day").over(newest_first), F.lit(first)).alias("_from"),
        F.date_sub("_day", 1).alias("_to"),
        F.sum("_change").over(so_far).alias("_undone"),
    )
    # A key has one amount however many rows of stock it has.
    available = F.when(F.col("available_amount") > 0, F.col("available_amount")).cast(_AMOUNT)
    now = stock.where(F.col("location_code").isNotNull() & F.col("storage").isNotNull()).select(
        *keys, "price", "flow_price", F.sum(available).over(Window.partitionBy(*keys)).alias("_now")
    )
    zero = F.lit(0).cast(_AMOUNT)
    amount = F.coalesce("_now", zero) + F.coalesce("_undone", zero)
    held = (
        now.join(rolled, keys, "left")
        .select(
            *keys, "price", "flow_price",
            F.coalesce("_from", F.lit(first)).alias("_from"),
            F.coalesce("_to", F.lit(last)).alias("_to"),
            amount.cast("decimal(38,2)").alias("amount"),
        )
        .where(F.col("amount") != 0)
        .join(_costs(batches), BATCH_KEYS)
        .withColumnsRenamed({"goods_code": "product_code", "location_code": "station_code"})
    )
    if by:
        held = held.repartition(*by)
    days = [F.explode(F.sequence("_from", "_to")).alias("date")]
    if stretches:
        days = [F.col("_from").alias("from"), F.col("_to").alias("to")]
    return held.select(
        *days,
        "batch_no",
        "supplier_code",
        "product_code",
        "station_code",
        "storage",
        "amount",
        "price",
        "flow_price",
        "cost_price",
    )


def _per_bay(daily: DataFrame) -> DataFrame:
    amount = F.col("amount")
    return daily.groupBy("date", "station_code", "product_code", "storage").agg(
        F.sum(amount * F.col("price")).alias("current_total_price"),
        F.sum(amount).alias("available_amount"),
        F.sum(amount * F.col("flow_price")).alias("price"),
        F.sum(amount * F.col("cost_price")).alias("cost_price"),
    )


def stock_detail_daily(
    daily: DataFrame, products: DataFrame, storages: DataFrame, stations: DataFrame
) -> DataFrame:
    """Wide stock rows per day, station, bay and product."""
    bays = storages.select(
        F.col("storage_code").alias("storage"), F.col("storage_name").alias("operation_type_name")
    )
    place = stations.select(
        F.col("new_station_code").alias("station_code"),
        F.col("new_station_name").alias("station_name"),
        "logistic_code",
        F.col("logistics_name").alias("logistic_name"),
        "station_region_code",
        "station_region_name",
    )
    return (
        _per_bay(daily)
        .join(bays, "storage")
        .join(products, "product_code")
        .join(place, "station_code")
        .drop("storage")
    )


def latest_stock(daily: DataFrame, products: DataFrame, storages: DataFrame, day: dt.date):
    """Stock of one day without station names."""
    bays = storages.select(
        F.col("storage_code").alias("storage"), F.col("storage_name").alias("operation_type_name")
    )
    return (
        _per_bay(daily.where(F.col("date") == F.lit(day)))
        .join(bays, "storage")
        .join(products.select("product_code", *PRODUCT_NAMES), "product_code")
        .drop("storage")
        .withColumnsRenamed({"date": "create_time", "station_code": "location_code"})
    )


def emphasis_stock(
    daily: DataFrame, products: DataFrame, stations: DataFrame, monitored: DataFrame, day: dt.date
) -> DataFrame:
    """Stock of monitored products split into shelf and in-transit amounts."""
    moving = F.col("storage") == IN_TRANSIT
    watchers = monitored.groupBy("product_code").agg(F.count(F.lit(1)).alias("_watchers"))
    place = stations.select(
        F.col("new_station_code").alias("station_code"),
        F.col("new_station_name").alias("station_name"),
        "logistic_code", "logistics_name", "station_region_code", "station_region_name",
    )
    zero = F.lit(0)
    return (
        daily.where(F.col("date") == F.lit(day))
        .groupBy("station_code", "product_code")
        .agg(
            F.coalesce(F.sum(F.when(~moving, F.col("amount"))), zero).alias("_local"),
            F.coalesce(F.sum(F.when(moving, F.col("amount"))), zero).alias("_moving"),
        )
        .join(watchers, "product_code")
        .join(products.select("product_code", "product_name"), "product_code")
        .join(place, "station_code")
        .withColumn("local_stock_amount", F.col("_local") * F.col("_watchers"))
        .withColumn("on_storage_stock_amount", F.col("_moving") * F.col("_watchers"))
        .drop("_local", "_moving", "_watchers")
    )
