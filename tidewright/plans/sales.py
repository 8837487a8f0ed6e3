"""Sales marts.  Every mart takes all days of its inputs at once, or a run of days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import materialise
from ..functions.codes import hour_band
from ..functions.dates import on_days
from ..operators.allocate import AMOUNT_TYPE, SHARE_TYPE, ratio, shares, spread
from ..operators.numbering import surrogate_ids
from ..operators.skew import deal, deal_groups, hot_hashes, split_join

Day = dt.date | None
CATEGORIES = (
    "category_two_name",
    "category_three_name",
    "category_four_name",
    "category_five_name",
)
CATEGORY_CODES = tuple(c.replace("_name", "_code") for c in CATEGORIES)
# Row types of the sale monitor.
CARD_SALE, PURE_RETAIL, PICKUP = "售卡", "纯零售实洋", "提货实洋"
# Category classes watched against the task table.
JUVENILE, LIFESTYLE, CALENDAR, REST = "少儿", "不二", "台历", "其他"


def _orders(orders: DataFrame, first: Day, last: Day, *columns: str) -> DataFrame:
    """Orders of the wanted days with their day and the columns a mart needs."""
    return orders.where(on_days(F.col("create_time"), first, last)).select(
        "sale_order_code", F.to_date("create_time").alias("create_date"), *columns
    )


def _some(first: Day, last: Day) -> bool:
    return not (first is None and last is None)


def _only(rows: DataFrame, wanted: DataFrame, first: Day, last: Day) -> DataFrame:
    """Rows of the wanted orders; without a day filter all of them, and no join is needed."""
    if not _some(first, last):
        return rows
    return split_join(rows, wanted.select("sale_order_code"), ["sale_order_code"], "left_semi")


def _lines(details: DataFrame, orders: DataFrame) -> DataFrame:
    return split_join(details, orders, ["sale_order_code"])


def _bought(details: DataFrame, orders: DataFrame, products: DataFrame, some_days: bool) -> DataFrame:
    """Order lines with their order and product.

    A run of days leaves few lines, so these meet their orders first.  Of all days, lines meet their
    products first: they then lie by order, and sums per order need no further shuffle.
    """
    if some_days:
        return split_join(_lines(details, orders), products, ["product_code"], keys_of=details)
    made = split_join(details, products, ["product_code"])
    return split_join(made, orders, ["sale_order_code"], keys_of=details)


def _classes(products: DataFrame, *categories: str) -> tuple[DataFrame, DataFrame]:
    """(product_code, ``_class``) and (``_class``, categories): combinations of categories, numbered.

    Rows carry the number through their shuffles; the names, one row per combination, are joined to
    the sums.  Null is a name like any other here.
    """
    none = products.sparkSession.createDataFrame([], "_class long")
    names = materialise(
        surrogate_ids(products.select(*categories).distinct(), categories, none, "_class"), "classes"
    )
    same = F.lit(True)
    for c in categories:
        same = same & F.col(f"p.{c}").eqNullSafe(F.col(f"n.{c}"))
    return products.alias("p").join(names.alias("n"), same).select("p.product_code", "n._class"), names


def _placed(orders: DataFrame, place: DataFrame) -> tuple[DataFrame, list[str]]:
    """Orders with the columns of their station, and the names of these.

    Orders are fewer than what is summed of them, so the station meets the order.  A place that is
    listed more than once is to give that many rows, ``_places``, after the sums.
    """
    counted = place.groupBy(*place.columns).agg(F.count(F.lit(1)).alias("_places"))
    columns = [c for c in place.columns if c != "station_code"]
    return split_join(orders, counted, ["station_code"]), [*columns, "_places"]


def _each_place(sums: DataFrame) -> DataFrame:
    """One row for each time a place is listed."""
    times = F.sequence(F.lit(1).cast("long"), F.col("_places"))
    return sums.withColumn("_place", F.explode(times)).drop("_place", "_places")


def _with_place_and_goods(sums: DataFrame, place: DataFrame, goods: DataFrame) -> DataFrame:
    """Sums with the columns of their station and product; the wider products come last, so that no
    shuffle moves them once for every row."""
    first = ["station_code", "product_code"]
    rest = [c for f in (sums, goods, place) for c in f.columns if c not in first]
    return sums.join(place, "station_code").join(goods, "product_code").select(*first, *rest)


def sale_by_category(
    orders: DataFrame, details: DataFrame, products: DataFrame, first: Day = None, last: Day = None
) -> DataFrame:
    """Signed list and real money per order and category."""
    wanted = _orders(
        orders, first, last, "sale_order_id", "sale_type_name", "station_code", "in_out_flag"
    )
    amount = F.col("sale_amount") * F.col("in_out_flag")
    return (
        _bought(details, wanted, products, _some(first, last))
        .groupBy(
            F.col("create_date").alias("create_time"),
            "sale_type_name",
            "sale_order_id",
            *CATEGORIES,
            "station_code",
            "fina_category_name",
        )
        .agg(
            F.sum(F.col("sale_price") * amount).alias("sale_price"),
            F.sum(F.col("sale_real_price") * amount).alias("sale_real_price"),
        )
    )


def sale_by_category_and_order(
    orders: DataFrame,
    details: DataFrame,
    products: DataFrame,
    stations: DataFrame,
    first: Day = None,
    last: Day = None,
) -> DataFrame:
    """Wide sale rows per order, station and finest category; days select on the pay date."""
    wanted = orders.where(on_days(F.col("pay_date"), first, last)).select(
        "sale_order_code",
        F.to_date("create_time").alias("date"),
        "station_code",
        "in_out_flag",
        "sale_type",
        "sale_type_name",
        F.col("member_type").alias("is_member"),
    )
    place = stations.select(
        F.col("new_station_code").alias("station_code"),
        F.col("new_station_name").alias("station_name"),
        "station_region_code",
        "station_region_name",
    )
    placed, places = _placed(wanted, place)
    codes, names = _classes(products, *CATEGORY_CODES, *CATEGORIES)
    keys = [
        "date", "sale_order_code", "in_out_flag", "station_code", "sale_type", "sale_type_name",
        "is_member",
    ]
    measures = {
        "sale_amount": "sale_amount", "sale_money": "sale_totalmoney", "sale_real_money": "sale_realmoney"
    }
    sums = (
        _bought(details, placed, codes, _some(first, last))
        .groupBy(*keys, *places, "_class")
        .agg(*[F.sum(F.col(c) * F.col("in_out_flag")).alias(name) for c, name in measures.items()])
    )
    rest = [k for k in keys if k != "station_code"]
    return _each_place(sums).join(names, "_class").select(
        "station_code", *rest, *CATEGORY_CODES, *CATEGORIES, *measures.values(), *[c for c in places if c != "_places"]
    )


def fine_by_category(
    changes: DataFrame, products: DataFrame, stations: DataFrame, orders: DataFrame,
    first: Day = None, last: Day = None, keys_of: DataFrame | None = None,
) -> DataFrame:
    """Retail documents of bookstores per bill and category in four valuations.

    ``keys_of`` (product_code) is the scan behind ``changes``, to count hot products on.
    """
    keys = ["date", "bill_code", "station_code"]
    amount = F.col("in_out_flag") * F.col("amount")
    shops = stations.where(F.col("category_code") == "BOOKSTORE").select(
        F.col("new_station_code").alias("station_code")
    )
    sold = changes.where((F.col("bill_type") == "SALE") & _days("date", first, last))
    sums = (
        split_join(sold, products.drop("supplier_code"), ["product_code"], keys_of=keys_of)
        .groupBy(*keys, "fina_category_name", *CATEGORIES)
        .agg(
            F.sum(-amount * F.col("price")).alias("sale_total_price"),
            F.sum(-amount * F.col("real_price")).alias("sale_real_price"),
            F.sum(-amount * F.col("flow_price")).alias("price"),
            F.sum(-amount * F.col("cost_price")).alias("cost_price"),
        )
    )
    types = orders.select(F.col("sale_order_code").alias("bill_code"), "sale_type_name")
    return (
        sums.join(shops, "station_code")
        .join(types, "bill_code")
        .withColumnsRenamed(
            {
                "date": "create_time",
                "bill_code": "payment_order_code",
                "station_code": "from_location_code",
            }
        )
    )


def _days(column: str, first: Day, last: Day) -> Column:
    keep = F.lit(True)
    if first is not None:
        keep = keep & (F.col(column) >= F.lit(first))
    if last is not None:
        keep = keep & (F.col(column) <= F.lit(last))
    return keep


def _category_shares(
    lines: DataFrame, products: DataFrame, details: DataFrame, *categories: str
) -> DataFrame:
    """Part of each category in the real money of its order; hot keys are counted on ``details``."""
    money = (
        deal(split_join(lines, products, ["product_code"], keys_of=details), ["sale_order_code"], details)
        .groupBy("sale_order_code", *categories)
        .agg(F.sum(F.col("sale_real_price") * F.col("sale_amount")).alias("_money"))
    )
    return shares(money, "sale_order_code", "_money").drop("_money")


def pay_by_category(
    orders: DataFrame, details: DataFrame, payments: DataFrame, pay_methods: DataFrame,
    products: DataFrame, first: Day = None, last: Day = None,
) -> DataFrame:
    """Payment money spread over categories by their part in the order; zero rows are dropped."""
    wanted = _orders(orders, first, last, "sale_type_name", "station_code", "in_out_flag")
    paid = (
        split_join(payments, wanted, ["sale_order_code"])
        .join(pay_methods.select("pay_method_code", "pay_method_name"), "pay_method_code")
        .groupBy(
            "sale_order_code", "create_date", "sale_type_name", "station_code", "pay_method_name"
        )
        .agg(F.sum(F.col("actual_money") * F.col("in_out_flag")).alias("_paid"))
    )
    bought = _only(details, wanted, first, last)
    codes, names = _classes(products, "fina_category_name", *CATEGORIES)
    parts = _category_shares(bought, codes, details, "_class")
    by_order = ["create_date", "sale_type_name", "station_code"]
    keys = [*by_order, "_class", "pay_method_name"]
    # One day of one station may have too many orders for a task; their pairs are then dealt by all keys.
    by = [] if hot_hashes(wanted, by_order) else by_order
    return (
        spread(paid, parts, "sale_order_code", "_paid", keys, "pay_money", by=by)
        .where(F.col("pay_money") != 0)
        .join(names, "_class")
        .select(
            F.col("create_date").alias("create_time"), "sale_type_name", "fina_category_name",
            *CATEGORIES, "station_code", "pay_method_name", "pay_money",
        )
    )


def money_section(
    orders: DataFrame, details: DataFrame, payments: DataFrame, pay_methods: DataFrame,
    products: DataFrame, stations: DataFrame, first: Day = None, last: Day = None,
) -> DataFrame:
    """Receipts per station, product and payment method, by each product's part in its order.

    Lines and payments are summed per order before they meet: pairing every line with every
    payment of an order gives the same sums at the product of the two counts.  The payments of an
    order, one per method, go along with its lines as an array, and the pairs are formed where they
    are summed and named, so no shuffle moves them.
    """
    wanted = _orders(orders, first, last, "sale_type_name", "station_code", "real_money")
    place = stations.select(
        F.col("new_station_code").alias("station_code"),
        F.col("new_station_name").alias("station_name"),
        "station_region_code",
        "station_region_name",
    )
    goods = products.select(
        "product_code", "product_isbn", "product_name", "product_price", *CATEGORIES,
        *CATEGORY_CODES, "supplier_code", "supplier_name",
    )
    placed, places = _placed(wanted, place)
    by_order = ["create_date", "sale_type_name", "station_code"]
    parts = (
        _lines(details, placed)
        .groupBy("sale_order_code", *by_order, "product_code", *places, "real_money")
        .agg(F.sum(F.col("sale_real_price") * F.col("sale_amount")).alias("_money"))
        .withColumn("share", ratio(F.col("_money"), F.col("real_money")).cast(SHARE_TYPE))
        .drop("_money", "real_money")
    )
    received = (
        deal(_only(payments, wanted, first, last), ["sale_order_code"], payments)
        .join(pay_methods.select("pay_method_code", "pay_method_name"), "pay_method_code")
        .groupBy("sale_order_code", "pay_method_name")
        .agg(F.sum("actual_money").cast(AMOUNT_TYPE).alias("_paid"))
        .groupBy("sale_order_code")
        .agg(F.collect_list(F.struct("pay_method_name", "_paid")).alias("_received"))
        .select("sale_order_code", "_received.pay_method_name", "_received._paid")
    )
    rows = split_join(parts, received, ["sale_order_code"], "left", keys_of=details).drop("sale_order_code")
    rows, goods, on = deal_groups(rows, goods, ["product_code"], by_order, details)
    sums = (
        rows.select(*by_order, *on, *places, "share", F.inline_outer(F.arrays_zip("pay_method_name", "_paid")))
        .groupBy(*by_order, *on, *places, "pay_method_name")
        .agg(F.sum(F.col("share") * F.col("_paid")).alias("receivables_money"))
    )
    rest = [c for c in [*by_order, "pay_method_name", "receivables_money", *goods.columns, *places] if c not in ("station_code", *on)]
    return (
        _each_place(sums.join(goods, on))
        .select("station_code", "product_code", *[c for c in rest if c != "_places"])
        .withColumnRenamed("create_date", "create_time")
    )


def marketing_activities(
    orders: DataFrame, details: DataFrame, payments: DataFrame, pay_methods: DataFrame,
    products: DataFrame, activities: DataFrame, first: Day = None, last: Day = None,
) -> DataFrame:
    """Sales and allocated pick-up money per day, category, activity and station."""
    wanted = _orders(orders, first, last, "station_code", "in_out_flag")
    tagged = activities.select("sale_order_code", "sale_activity_name")
    keys = ["create_date", "category_two_name", "sale_activity_name", "station_code"]
    flag = F.col("in_out_flag")
    # Per order and category first, so an order with several activities repeats few rows.
    per_order = (
        _bought(details, wanted, products, _some(first, last))
        .groupBy("sale_order_code", "create_date", "category_two_name", "station_code")
        .agg(
            F.sum(F.col("sale_amount") * flag).alias("_amount"),
            F.sum(F.col("sale_price") * flag * F.col("sale_amount")).alias("_total"),
            F.sum(F.col("sale_real_price") * flag).alias("_real"),
        )
    )
    sold = (
        split_join(tagged, per_order, ["sale_order_code"])
        .groupBy(*keys)
        .agg(
            F.sum("_amount").alias("sale_amount"),
            F.sum("_total").alias("total_price"),
            F.sum("_real").alias("real_price"),
        )
    )
    pickup = pay_methods.where("count_in_pickup = '1'").select("pay_method_code")
    taken = (
        split_join(
            payments.join(pickup, "pay_method_code"), wanted, ["sale_order_code"], keys_of=payments
        )
        .groupBy("sale_order_code", "create_date", "station_code")
        .agg(F.sum(F.col("actual_money") * flag).alias("_taken"))
    )
    taken = split_join(tagged, taken, ["sale_order_code"])
    bought = _only(details, wanted, first, last)
    parts = _category_shares(bought, products, details, "category_two_name")
    picked = spread(taken, parts, "sale_order_code", "_taken", keys, "take_price")
    both = sold.unionByName(picked, allowMissingColumns=True)
    measures = ["sale_amount", "total_price", "real_price", "take_price"]
    return (
        both.groupBy(*keys)
        .agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures])
        .withColumnsRenamed({"create_date": "dates", "category_two_name": "category_one_name"})
    )


def hourly_kpi(orders: DataFrame, first: Day = None, last: Day = None) -> DataFrame:
    """Bills, members, money and per-bill averages per station, trading hours and sale type."""
    flag = F.col("in_out_flag")
    sums = (
        orders.where(on_days(F.col("create_time"), first, last))
        .groupBy(
            F.to_date("create_time").alias("create_date"),
            "station_code",
            hour_band(F.col("create_time")).alias("sale_hour_range"),
            "sale_type_name",
        )
        .agg(
            F.sum(flag).alias("sale_bill_amount"),
            F.coalesce(
                F.sum(F.when(F.col("member_code").isNotNull(), flag)), F.lit(0)
            ).alias("member_sale_bill_amount"),
            F.sum("total_amount").alias("sale_amount"),
            F.sum("total_money").alias("sale_total_money"),
            F.sum("real_money").alias("sale_real_money"),
        )
        .withColumnRenamed("create_date", "create_time")
    )
    bills, amount = F.col("sale_bill_amount"), F.col("sale_amount")
    total, real = F.col("sale_total_money"), F.col("sale_real_money")
    return sums.withColumns(
        {
            "total_money_per_bill": ratio(total, bills),
            "real_money_per_bill": ratio(real, bills),
            "sale_amount_per_bill": ratio(amount, bills),
            "total_money_per_sku": ratio(total, amount),
            "real_money_per_sku": ratio(real, amount),
        }
    )


def product_sale_detailed(
    orders: DataFrame, details: DataFrame, products: DataFrame, stations: DataFrame,
    passenger_flow: DataFrame, first: Day = None, last: Day = None,
) -> DataFrame:
    """Product sales per day and station with purchase ratio (bills) and deal ratio (visitors)."""
    wanted = _orders(orders, first, last, "station_code", "sale_type_name", "in_out_flag")
    keys = ["create_date", "station_code", "sale_type_name", "product_code"]
    sold = (
        _lines(details, wanted)
        .groupBy(*keys)
        .agg(
            F.sum(F.col("sale_price") * F.col("sale_amount")).alias("sale_price"),
            F.sum(F.col("sale_amount") * F.col("in_out_flag")).alias("sale_amount"),
            F.sum("sale_real_price").alias("sale_real_price"),
            F.sum("in_out_flag").alias("in_out_flag_count"),
        )
        .where(F.col("sale_amount") > 0)
    )
    bills = wanted.groupBy("create_date", "station_code").agg(
        F.sum("in_out_flag").alias("_bills")
    )
    visitors = passenger_flow.select(
        F.col("record_date").alias("create_date"), "station_code", "info_value"
    )
    place = stations.select(
        F.col("new_station_code").alias("station_code"),
        F.col("new_station_name").alias("station_name"),
        "station_region_code",
        "station_region_name",
    )
    goods = products.select(
        "product_code", "product_isbn", "product_name", "product_price", *CATEGORIES,
        *CATEGORY_CODES, "supplier_code", "supplier_name",
    )
    count = F.col("in_out_flag_count")
    rated = (
        sold.join(bills, ["create_date", "station_code"], "left")
        .join(visitors, ["create_date", "station_code"], "left")
        .withColumn("purchase_ratio", ratio(count, F.col("_bills")))
        .withColumn("deal_ratio", ratio(count, F.col("info_value")))
        .drop("_bills", "info_value")
    )
    return _with_place_and_goods(rated, place, goods).withColumnRenamed("create_date", "dates")


def category_vs_task(
    orders: DataFrame, details: DataFrame, products: DataFrame, tasks: DataFrame,
    first: Day = None, last: Day = None,
) -> DataFrame:
    """Real money per watched category class beside the day's task money."""
    two, three = F.col("category_two_code"), F.col("category_three_code")
    kind = (
        F.when(two == "01", JUVENILE)
        .when(three == "1204", JUVENILE)
        .when(two == "13", LIFESTYLE)
        .when(two == "21", CALENDAR)
        .otherwise(REST)
    )
    wanted = _orders(orders, first, last, "station_code", "in_out_flag")
    money = F.col("sale_real_price") * F.col("sale_amount") * F.col("in_out_flag")
    sold = (
        _bought(details, wanted, products, _some(first, last))
        .groupBy("create_date", "station_code", kind.alias("type"))
        .agg(F.sum(money).alias("real_money"))
        .withColumnRenamed("create_date", "create_time")
    )
    task = (
        tasks.where(_days("create_time", first, last))
        .select(
            "create_time",
            "station_code",
            F.explode(
                F.create_map(
                    F.lit(JUVENILE), F.col("juvenile"),
                    F.lit(REST), F.col("other"),
                    F.lit(LIFESTYLE), F.col("up2"),
                )
            ).alias("type", "task_money"),
        )
    )
    return (
        sold.unionByName(task, allowMissingColumns=True)
        .groupBy("create_time", "station_code", "type")
        .agg(
            F.coalesce(F.sum("real_money"), F.lit(0)).alias("real_money"),
            F.coalesce(F.sum("task_money"), F.lit(0)).alias("task_money"),
        )
    )


def sale_monitor(
    orders: DataFrame, payments: DataFrame, pay_methods: DataFrame, trades: DataFrame,
    stations: DataFrame, first: Day = None, last: Day = None,
) -> DataFrame:
    """Card sales, pure retail and pick-up money per day, station and operator, as typed rows."""
    from .cards import recharges

    shops = stations.where(F.col("category_code") == "BOOKSTORE").select(
        F.col("new_station_code").alias("station_code")
    )
    valid = recharges(trades)
    origin = valid.select(
        F.col("trade_number").alias("source_id"), F.col("discount").alias("_discount")
    )
    cards = (
        split_join(
            valid.where(on_days(F.col("create_time"), first, last)), origin, ["source_id"], "left"
        )
        .withColumn(
            "_money",
            F.col("trade_amount")
            * F.coalesce(F.col("_discount"), F.col("discount"))
            * F.col("in_out_flag"),
        )
        .groupBy(F.to_date("create_time").alias("create_date"), "station_code", "operator_code")
        .agg(F.sum("_money").alias("pay_money"))
        .join(shops, "station_code")
        .withColumn("type", F.lit(CARD_SALE))
    )
    pickup = (F.col("count_in_card_pickup") == "1") | (F.col("count_in_other_pickup") == "1")
    # One scan of the payments feeds both kinds; a method may count as both.
    kinds = pay_methods.select(
        "pay_method_code",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.col("count_in_retail") == "1", PURE_RETAIL),
                    F.when(pickup, PICKUP),
                )
            )
        ).alias("type"),
    )
    wanted = _orders(orders, first, last, "station_code", "new_operator_code", "in_out_flag")
    paid = (
        split_join(payments, wanted, ["sale_order_code"])
        .join(kinds, "pay_method_code")
        .groupBy(
            "create_date", "station_code", F.col("new_operator_code").alias("operator_code"), "type"
        )
        .agg(F.sum(F.col("pay_money") * F.col("in_out_flag")).alias("pay_money"))
    )
    return cards.unionByName(paid).withColumnRenamed("create_date", "create_time")


def operator_daily_sale(monitor: DataFrame, operators: DataFrame) -> DataFrame:
    """Revenue and pick-up money per operator in one pass over the sale monitor."""

    def money(*types: str) -> Column:
        return F.sum(F.when(F.col("type").isin(*types), F.col("pay_money")))

    return (
        monitor.groupBy("create_time", "station_code", "operator_code")
        .agg(
            money(PURE_RETAIL, CARD_SALE).alias("sale_money"),
            money(PURE_RETAIL, PICKUP).alias("withdraw_real_money"),
        )
        .join(operators.withColumnRenamed("user_code", "operator_code"), "operator_code")
        .withColumnsRenamed({"operator_code": "new_operator_code", "user_name": "new_user_name"})
    )


def emphasis_sale(
    orders: DataFrame, details: DataFrame, wholesale: DataFrame, wholesale_details: DataFrame,
    products: DataFrame, monitored: DataFrame, first: Day = None, last: Day = None,
) -> DataFrame:
    """Retail and wholesale of monitored products side by side, per day and station."""
    keys = ["date", "station_code", "product_code"]
    # A product watched by several users counts once per user; only the count is joined.
    watchers = monitored.groupBy("product_code").agg(F.count(F.lit(1)).alias("_watchers"))
    wanted = orders.where(on_days(F.col("create_time"), first, last)).select(
        "sale_order_code", F.to_date("pay_date").alias("date"), "station_code", "in_out_flag"
    )
    amount = F.col("sale_amount") * F.col("in_out_flag")
    retail = (
        _lines(details, wanted)
        .groupBy(*keys)
        .agg(
            F.sum(amount).alias("sale_amount"),
            F.sum(amount * F.col("sale_price")).alias("sale_totalmoney"),
            F.sum(amount * F.col("sale_real_price")).alias("sale_realmoney"),
        )
        .join(products.select("product_code"), "product_code")
    )
    bills = wholesale.where(on_days(F.col("create_time"), first, last)).select(
        F.col("code").alias("bill_code"),
        F.to_date("create_time").alias("date"),
        F.col("own_station_code").alias("station_code"),
        "bill_type",
    )
    out = F.col("amount") * F.when(F.col("bill_type") == "OUT", 1).when(
        F.col("bill_type") == "IN", -1
    ).otherwise(0)
    batch = (
        split_join(
            wholesale_details.withColumnRenamed("h_id", "product_code"), bills, ["bill_code"]
        )
        .groupBy(*keys)
        .agg(
            F.sum(out).alias("batch_sale_amount"),
            F.sum(out * F.col("price")).alias("batch_sale_totalmoney"),
            F.sum(out * F.col("real_price")).alias("batch_sale_realmoney"),
        )
    )
    measures = [
        "sale_amount", "sale_totalmoney", "sale_realmoney",
        "batch_sale_amount", "batch_sale_totalmoney", "batch_sale_realmoney",
    ]
    return (
        retail.unionByName(batch, allowMissingColumns=True)
        .join(watchers, "product_code")
        .groupBy(*keys)
        .agg(*[F.coalesce(F.sum(F.col(m) * F.col("_watchers")), F.lit(0)).alias(m) for m in measures])
    )


def emphasis_with_stock(sale: DataFrame, stock: DataFrame) -> DataFrame:
    """Sale rows with the stock columns filled in; no stock row means zero."""
    measures = ["local_stock_amount", "on_storage_stock_amount"]
    keys = ["station_code", "product_code"]
    return (
        sale.join(stock.select(*keys, *measures), keys, "left")
        .withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in measures})
    )
