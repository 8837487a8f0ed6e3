"""Wide columns are not moved for every row."""

import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidewright.operators import allocate, skew
from tidewright.plans import sales

PART = ("fina_category_name", *sales.CATEGORIES, *sales.CATEGORY_CODES)


@pytest.fixture(scope="module")
def shop(spark):
    """Two lines of one class, one of another, a product without categories and one listed twice."""
    order = Row("sale_order_code", "create_time", "pay_date", "station_code", "in_out_flag", "sale_type",
                "sale_type_name", "member_type")
    time = "2024-01-01 10:00:00"
    orders = spark.createDataFrame(
        [order(1, time, time, 5, 1, "O", "till", "m"), order(2, time, time, 5, -1, "O", "till", "m"),
         order(3, time, time, None, 1, "O", "till", "m")]
    ).withColumns(
        {c: F.col(c).cast("timestamp") for c in ("create_time", "pay_date")}
    )
    details = spark.createDataFrame(
        [(1, 10, 2, 3.0), (1, 11, 1, 4.0), (1, 12, 1, 8.0), (2, 13, 1, 5.0), (3, 10, 9, 9.0), (None, 10, 7, 7.0)],
        "sale_order_code long, product_code long, sale_amount int, p double",
    ).selectExpr(
        "sale_order_code", "product_code", "sale_amount", "CAST(p AS DECIMAL(12,2)) AS sale_price",
        "CAST(p AS DECIMAL(14,4)) AS sale_real_price", "CAST(p * sale_amount AS DECIMAL(18,2)) AS sale_money",
        "CAST(p * sale_amount AS DECIMAL(18,4)) AS sale_real_money",
    )
    names = [f"CASE WHEN c <> 'none' THEN concat('{c}', c) END AS {c}" for c in PART]
    products = spark.createDataFrame(
        [(10, "a"), (11, "a"), (12, "b"), (13, "none"), (12, "b")], "product_code long, c string"
    ).selectExpr("product_code", *names)
    stations = spark.createDataFrame(
        [(5, "five", 1, "north"), (5, "five", 1, "north"), (6, "six", 2, "south")],
        "new_station_code long, new_station_name string, station_region_code long, station_region_name string",
    )
    return orders, details, products, stations


def test_sale_detail_wide_rows(shop):
    rows = sales.sale_by_category_and_order(*shop).collect()
    got = sorted(
        (r["sale_order_code"], r["category_two_name"] or "", r["sale_amount"], float(r["sale_totalmoney"]), r["station_name"])
        for r in rows
    )
    once = [
        (1, "category_two_namea", 3, 10.0, "five"),
        (1, "category_two_nameb", 2, 16.0, "five"),
        (2, "", -1, -5.0, "five"),
    ]
    assert got == sorted(once * 2)  # the station is listed twice


def _shuffles(df):
    """Column names of every row shuffle in the plan, as the plan prints them."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def _no_broadcast(spark, build):
    """Shuffles of a plan without broadcasts; ``HOT_PART`` 1 so that few rows have no hot keys."""
    patch = pytest.MonkeyPatch()
    patch.setattr(skew, "HOT_PART", 1.0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return _shuffles(build())
    finally:
        patch.undo()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_sums_of_an_order_are_not_shuffled_by_names(spark, shop):
    found = _no_broadcast(spark, lambda: sales.sale_by_category_and_order(*shop))
    assert not [x for x in found if "sale_order_code" in x and "sale_type_name" in x]


def test_payments_are_summed_by_the_number_of_a_class(spark, shop):
    orders, details, products, _ = shop
    payments = spark.createDataFrame(
        [(1, 1, 13.0), (2, 1, 5.0)], "sale_order_code long, pay_method_code long, m double"
    ).selectExpr("sale_order_code", "pay_method_code", "CAST(m AS DECIMAL(14,4)) AS actual_money")
    methods = spark.createDataFrame([(1, "cash")], "pay_method_code long, pay_method_name string")

    def build():
        return sales.pay_by_category(orders, details, payments, methods, products)

    found = _no_broadcast(spark, build)
    assert not [x for x in found if "pay_method_name" in x and "category_two_name" in x]
    got = sorted((r["category_two_name"] or "", float(r["pay_money"])) for r in build().collect())
    # 10 + 16 of order 1, whose product 12 is listed twice; the whole of order 2.
    want = [("", -5.0), ("category_two_namea", 5.0), ("category_two_nameb", 8.0)]
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want])


def test_an_order_is_moved_as_one_row_for_all_its_pairs(spark, shop):
    orders, details, products, _ = shop
    payments = spark.createDataFrame(
        [(1, 1, 13.0), (1, 2, 4.0), (2, 1, 5.0), (2, 3, None), (3, 9, 1.0)], "sale_order_code long, pay_method_code long, m double"
    ).selectExpr("sale_order_code", "pay_method_code", "CAST(m AS DECIMAL(14,4)) AS actual_money")
    methods = spark.createDataFrame([(1, "cash"), (2, None), (3, "card")], "pay_method_code long, pay_method_name string")

    def build():
        return sales.pay_by_category(orders, details, payments, methods, products)

    found = _no_broadcast(spark, build)
    assert not [x for x in found if "_class" in x and "station_code" in x]
    # where a station and day is hot, pairs are dealt by all keys; few rows make every one hot
    assert [x for x in _shuffles(build()) if "_class" in x and "station_code" in x]
    got = {(r["sale_type_name"], r["category_two_name"], r["pay_method_name"]): float(r["pay_money"]) for r in build().collect()}
    # of order 1 the classes have 10 and 16 of 26, as its product 12 is listed twice
    assert got == {
        ("till", "category_two_namea", "cash"): pytest.approx(5.0), ("till", "category_two_nameb", "cash"): pytest.approx(8.0),
        ("till", "category_two_namea", None): pytest.approx(40 / 26), ("till", "category_two_nameb", None): pytest.approx(64 / 26),
        ("till", None, "cash"): pytest.approx(-5.0),
    }


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_by_orders_equals_spread_by_pairs(spark, how):
    amounts = spark.createDataFrame(
        [(1, "d", "s", "m", 3.0), (1, "d", "s", None, 4.0), (1, "d", "s", "m", None), (2, "d", "s", "m", 5.0), (4, "e", None, "n", 6.0),
         (None, "d", "s", "m", 7.0), (3, None, "t", "n", None), (3, "d", "t", "n", 9.0)],
        "o long, day string, station string, method string, p double",
    ).withColumn("p", F.col("p").cast("decimal(24,4)"))
    parts = spark.createDataFrame(
        [(1, "a", 0.25), (1, None, 0.75), (2, "a", 1.0), (3, "a", None), (3, "b", 0.5), (None, "a", 0.5)], "o long, c string, share double"
    ).withColumn("share", F.col("share").cast("decimal(19,12)"))
    keys = ["day", "station", "method", "c"]
    plainly = allocate.spread(amounts, parts, "o", "p", keys, "x", how)
    dealt = allocate.spread(amounts, parts, "o", "p", keys, "x", how, by=["day", "station"])
    assert dealt.schema.simpleString() == plainly.schema.simpleString()
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plainly.collect()))
    assert dealt.count() == {"inner": 8, "left": 9}[how]


def test_pairs_of_lines_and_payments_are_not_moved(spark, shop):
    orders, details, products, stations = shop
    orders = orders.withColumn("real_money", F.col("sale_order_code").cast("decimal(12,2)") - 2)  # order 2 has none
    goods = products.selectExpr(
        "*", "concat('I', product_code) AS product_isbn", "'p' AS product_name", "CAST(1 AS DECIMAL(12,2)) AS product_price",
        "3L AS supplier_code", "'s' AS supplier_name",
    )
    payments = spark.createDataFrame(
        [(1, 1, 13.0), (1, 2, 5.0), (1, 3, 2.0), (1, 9, 4.0), (2, 2, 5.0), (None, 1, 7.0), (1, 4, None)],
        "sale_order_code long, pay_method_code long, m double",
    ).selectExpr("sale_order_code", "pay_method_code", "CAST(m AS DECIMAL(14,4)) AS actual_money")
    methods = spark.createDataFrame(
        [(1, "cash"), (2, "card"), (3, "cash"), (4, None)], "pay_method_code long, pay_method_name string"
    )
    more = orders.where("sale_order_code = 1").withColumn("sale_order_code", F.lit(7).cast("long"))  # not paid
    orders = orders.unionByName(more)
    details = details.unionByName(details.where("sale_order_code = 1").withColumn("sale_order_code", F.lit(7).cast("long")))

    def build():
        return sales.money_section(orders, details, payments, methods, goods, stations)

    found = _no_broadcast(spark, build)
    assert not [x for x in found if "create_date" in x]
    assert len([x for x in found if x.startswith("product_code#") and "," not in x.rpartition(",")[0]]) == 2
    keys = ["create_date", "sale_type_name", "station_code", "product_code"]
    share = F.try_divide(F.col("money").cast("double"), F.col("real_money").cast("double")).cast("decimal(19,12)")
    lines = details.join(
        orders.select("sale_order_code", F.to_date("create_time").alias("create_date"), *keys[1:3], "real_money"), "sale_order_code"
    ).groupBy("sale_order_code", *keys, "real_money").agg(F.sum(F.col("sale_real_price") * F.col("sale_amount")).alias("money"))
    paid = payments.join(methods, "pay_method_code").groupBy("sale_order_code", "pay_method_name").agg(F.sum("actual_money").alias("paid"))
    sums = lines.join(paid, "sale_order_code", "left").groupBy(*keys, "pay_method_name").agg(
        F.sum(share * F.col("paid").cast("decimal(18,4)")).alias("receivables_money")
    )
    place = stations.withColumnsRenamed({"new_station_code": "station_code", "new_station_name": "station_name"})
    want = sums.join(place, "station_code").join(goods.drop("fina_category_name"), "product_code").withColumnRenamed("create_date", "create_time")
    rows = sorted(map(str, want.select(*sorted(want.columns)).collect()))
    assert len(rows) > 20 and "pay_method_name=None" in "".join(rows)

    def got():
        df = build()
        return sorted(map(str, df.select(*sorted(df.columns)).collect()))

    assert got() == rows
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert got() == rows  # every key counts as hot in so few rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_goods_are_joined_last(spark, shop):
    orders, details, _, stations = shop
    sums = orders.selectExpr("station_code", "sale_order_code AS product_code", "2 AS n")
    goods = spark.createDataFrame([(1, "g")], "product_code long, product_name string")
    place = stations.selectExpr("new_station_code AS station_code", "new_station_name AS station_name")
    out = sales._with_place_and_goods(sums, place, goods)
    assert out.columns == ["station_code", "product_code", "n", "product_name", "station_name"]
    found = _no_broadcast(spark, lambda: sales._with_place_and_goods(sums, place, goods))
    assert "product_code" in found[0]
