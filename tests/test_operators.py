import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewright.durable import shared_folder
from tidewright.operators import allocate, audit, dayruns, incremental, numbering, skew
from tidewright.plans import batches, cards, consumption, dimensions, sales, stock
from tidewright.sources import catalog, jdbc, tables


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def test_split_join_equals_plain_join_with_a_hot_third(spark):
    facts = spark.range(60_000).selectExpr("IF(id % 3 = 0, 7L, id) AS k", "id AS v")
    facts = facts.unionByName(spark.range(50).selectExpr("CAST(NULL AS BIGINT) AS k", "id AS v"))
    lookup = spark.range(0, 60_000, 2).selectExpr("id + 1 AS k", "id AS w").unionByName(
        spark.sql("SELECT 7L AS k, -1L AS w")
    )
    seven = spark.sql("SELECT xxhash64(7L) h").first()["h"]
    assert skew.hot_hashes(facts, ["k"]) == [seven]
    assert skew.hot_hashes(facts.where("k <> 7"), ["k"]) == []
    for how in ("inner", "left", "left_semi", "left_anti"):
        for big in ("-1", "10485760"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", big)
            a = skew.split_join(facts, lookup, ["k"], how)
            b = facts.join(lookup, "k", how)
            total = [F.count("*"), *map(F.sum, a.columns), F.sum(F.xxhash64(*a.columns) % 1000)]
            assert a.agg(*total).first() == b.agg(*total).first()
    with pytest.raises(ValueError):
        skew.split_join(facts, lookup, ["k"], "full")


def test_hot_rows_are_dealt_over_many_tasks(spark):
    facts = spark.range(40_000).selectExpr("IF(id % 2 = 0, 7L, id) AS k", "1 AS v")
    lookup = spark.range(40_000).selectExpr("id AS k", "id AS w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = (
            skew.split_join(facts, lookup, ["k"]).where("k = 7")
            .groupBy(F.spark_partition_id()).count().collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 20_000 / 2


def test_allocated_money_adds_up_and_zero_totals_give_null(spark):
    parts = spark.createDataFrame(
        [(1, "a", Decimal("1.00")), (1, "b", Decimal("2.00")), (2, "a", Decimal("0.00"))],
        "o int, c string, m decimal(10,2)",
    )
    shared = allocate.shares(parts, "o", "m")
    paid = spark.createDataFrame([(1, Decimal("10.00")), (2, Decimal("5.00"))], "o int, p decimal(10,2)")
    out = {r["c"]: r["x"] for r in allocate.spread(paid, shared, "o", "p", ["c"], "x").collect()}
    assert abs(out["a"] + out["b"] - Decimal(10)) < Decimal("1e-9")
    assert [r["share"] for r in shared.where("o = 2").collect()] == [None]


def test_surrogate_ids_continue_densely(spark):
    df = spark.range(5000).selectExpr("5000 - id AS k")
    out = numbering.surrogate_ids(df, ["k"], spark.createDataFrame([("41",)], "n string"), "n", parts=7)
    assert out.where("n <> k + 41").count() == 0 and out.count() == 5000
    none = spark.createDataFrame([], "n bigint")
    assert rows(numbering.surrogate_ids(df.where("k < 3"), ["k"], none, "n")) == [(1, 1), (2, 2)]


def test_high_water_marks(spark):
    src = spark.createDataFrame([("9", "A"), ("10", "A"), ("11", "B")], "id string, origin string")
    dst = spark.createDataFrame([("9", "A")], "id string, origin string")
    assert rows(incremental.newer_than(src, dst, "id"), "id") == [("10",), ("11",)]
    empty = dst.where("false")
    assert incremental.newer_than(src, empty, "id").count() == 3
    src = src.selectExpr("CAST(id AS INT) AS id", "origin")
    dst = dst.selectExpr("CAST(id AS INT) AS id", "origin")
    assert rows(incremental.newer_than_per_source(src, dst, "id", ["origin"]), "id") == [(10,), (11,)]
    days = spark.createDataFrame([(dt.date(2018, 12, 31),), (dt.date(2019, 1, 1),)], "d date")
    assert incremental.newer_than(days, days.where("false"), "d", dt.date(2018, 12, 31)).count() == 1


def test_first_source_wins_and_code_translation(spark):
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "b")], "k int, v string")
    assert rows(incremental.first_source_wins(a, b, ["k"])) == [(1, "a"), (2, "b")]
    names = spark.createDataFrame([("o", "n2"), ("o", "n1"), (None, "z")], "old string, new string")
    df = spark.createDataFrame([("o", "q"), ("p", None)], "x string, y string")
    assert rows(incremental.translate_codes(df, names, ["x", "y"])) == [("n1", "q"), ("p", None)]


def test_day_reload_leaves_other_days(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame(
        [(dt.date(2020, 1, d), d) for d in (1, 2, 3)], "date date, v int"
    )
    tables.reload_days(df, path)
    tables.reload_days(df.where("v = 2").withColumn("v", F.lit(20)), path)
    tables.append(df.where("v = 3").drop("date").withColumn("date", F.lit(dt.date(2020, 1, 4))), str(tmp_path / "u"))
    got = tables.read_days(spark, path, dt.date(2020, 1, 2), dt.date(2020, 1, 3))
    assert rows(got, "v") == [(20,), (3,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    tables.reload_days(df.where("v <> 2"), path, dt.date(2020, 1, 2), dt.date(2020, 1, 3))
    assert rows(spark.read.parquet(path), "v") == [(1,), (3,)]
    with pytest.raises(ValueError):
        tables.reload_days(df, path, dt.date(2020, 1, 2))


def test_extract_modes(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a")], "id int, origin_system string")
    assert tables.extract(df, None, "full", columns=["id"]).columns == ["id"]
    assert tables.extract(df, df.where("id = 1"), "by_id").count() == 1
    assert tables.extract(df, df.where("id = 1"), "by_source").count() == 1
    with pytest.raises(ValueError):
        tables.extract(df, df, "other")


class FakeIO:
    """Stands where spark.read or df.write stands and records what it is given."""

    def __init__(self, bounds=None):
        self.given, self.bounds = {}, bounds

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **kw):
        self.given.update(kw)
        return self

    def option(self, key, value):
        self.given[key] = value
        return self

    def mode(self, m):
        self.given["mode"] = m
        return self

    def load(self):
        return self

    def save(self):
        return None

    def agg(self, *_):
        return self

    def first(self):
        return self.bounds

    @property
    def read(self):
        return self

    @property
    def write(self):
        return self


def test_jdbc_options(spark):
    io = FakeIO({"lo": 5, "hi": 90})
    jdbc.read_jdbc(io, {"url": "u"}, "t", jdbc.Split("id", 4))
    assert io.given["partitionColumn"] == "id" and io.given["numPartitions"] == "4"
    assert (io.given["lowerBound"], io.given["upperBound"]) == ("5", "90")
    io = FakeIO()
    jdbc.read_jdbc(io, {"url": "u", "fetchsize": "7"}, "t")
    assert "partitionColumn" not in io.given and io.given["fetchsize"] == "7"
    io = FakeIO({"lo": None, "hi": None})
    jdbc.read_jdbc(io, {}, "t", jdbc.Split("id", 4))
    assert "lowerBound" not in io.given
    io = FakeIO()
    jdbc.append_jdbc(io, {"url": "u"}, "t", batch=9)
    assert io.given["isolationLevel"] == "NONE" and io.given["batchsize"] == "9"
    io = FakeIO()
    jdbc.overwrite_jdbc(io, {}, "t")
    assert io.given["truncate"] == "true" and io.given["mode"] == "overwrite"


def test_shared_folder_must_be_named_on_a_cluster():
    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key, default)

        def set(self, key, value):
            self[key] = value

    class Context:
        master = "yarn"

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(ValueError):
        shared_folder(Session())
    Session.conf.set("spark.checkpoint.dir", "hdfs://x/y/")
    assert shared_folder(Session()) == "hdfs://x/y"


def ledger_rows(spark, data):
    return spark.createDataFrame(
        data,
        "batch_no string, goods_code int, from_location_code int, from_location_storage string,"
        " amount int, bill_purpose string, create_time timestamp_ntz",
    )


def test_back_rolled_stock_matches_a_day_by_day_count(spark):
    now = spark.createDataFrame(
        [("b", 1, 1, "N", 10, Decimal(2), Decimal(1)), ("b", 2, 1, "N", 0, Decimal(3), Decimal(1))],
        "batch_no string, goods_code int, location_code int, storage string, available_amount int,"
        " price decimal(10,2), flow_price decimal(10,2)",
    )
    t = dt.datetime
    moves = [
        (1, 4, "IN_STORAGE", t(2020, 1, 3)), (1, 1, "OUT_STORAGE", t(2020, 1, 3, 23, 59)),
        (1, 6, "IN_STORAGE", t(2020, 1, 5)), (1, 9, "OUT_STORAGE", t(2020, 1, 9)),
        (2, 5, "OUT_STORAGE", t(2020, 1, 4)), (1, 100, "IN_STORAGE", t(2019, 12, 1)),
    ]
    ledger = ledger_rows(spark, [("b", g, 1, "N", n, p, at) for g, n, p, at in moves])
    cost = spark.createDataFrame(
        [("b", 1, 8, Decimal(1)), ("b", 2, 8, Decimal(1))],
        "batch_no string, goods_code int, supplier_code int, cost_price decimal(10,2)",
    )
    first, last = dt.date(2020, 1, 1), dt.date(2020, 1, 6)
    got = {
        (r["date"], r["product_code"]): r["amount"]
        for r in stock.back_rolled_stock(now, ledger, cost, first, last).collect()
    }
    want = {}
    for n in range(6):
        day = first + dt.timedelta(days=n)
        for goods, held in ((1, 10), (2, 0)):
            for g, amount, purpose, at in moves:
                if g == goods and at.date() > day:
                    held += amount if purpose == "OUT_STORAGE" else -amount
            if held:
                want[(day, goods)] = held
    assert got == want
    latest = stock.back_rolled_stock(now, ledger, cost, dt.date(2020, 1, 9), dt.date(2020, 1, 9))
    assert rows(latest, "product_code", "amount") == [(1, Decimal("10.00"))]


def test_refund_before_its_original_does_not_count(spark):
    t = dt.datetime
    data = [
        (1, None, "Recharge", "Succeed", 100, t(2020, 1, 2)),
        (2, 1, "RechargeRollback", "Succeed", 100, t(2020, 1, 2)),
        (3, 4, "RechargeRollback", "Succeed", 100, t(2020, 1, 1)),
        (4, None, "Recharge", "Succeed", 100, t(2020, 1, 3)),
        (5, 4, "RechargeRollback", "Succeed", 50, t(2020, 1, 4)),
        (6, 4, "RechargeRollback", "Failed", 100, t(2020, 1, 4)),
    ]
    trades = spark.createDataFrame(
        [(a, b, c, d, Decimal(e), Decimal(e), 1, "op", 7, 1 if c == "Recharge" else -1, f) for a, b, c, d, e, f in data],
        "trade_number int, parent_trade_number int, trade_type string, status string,"
        " pay_amount decimal(10,2), trade_amount decimal(10,2), station_code int,"
        " operator_code string, card_number int, in_out_flag int, create_time timestamp_ntz",
    )
    got = {r["date"].day: r["recharge_count"] for r in cards.recharge_consume(trades).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 0}
    one = cards.recharge_consume(trades, dt.date(2020, 1, 2), dt.date(2020, 1, 2)).collect()
    assert [(r["recharge_count"], r["recharge_realmoney"]) for r in one] == [(0, Decimal(0))]


def test_latest_price_takes_the_newest_document(spark):
    bills = spark.createDataFrame(
        [(1, "PURCHASE", "IN_STORAGE", dt.datetime(2020, 1, 1)), (2, "PURCHASE", "IN_STORAGE", dt.datetime(2020, 2, 1)),
         (3, "SALE", "OUT_STORAGE", dt.datetime(2020, 3, 1))],
        "bill_code int, bill_type string, bill_purpose string, create_time timestamp_ntz",
    )
    lines = spark.createDataFrame(
        [(1, 5, Decimal(10), Decimal("0.5")), (2, 5, Decimal(8), Decimal("0.5")), (2, 5, Decimal(6), Decimal("0.5")),
         (3, 5, Decimal(99), Decimal(1))],
        "bill_code int, goods_code int, price decimal(10,2), discount decimal(3,2)",
    )
    got = batches.latest_price(bills, lines, "PURCHASE")
    assert rows(got, "goods_code", "cost_price") == [(5, Decimal("4.0000"))]
    goods = spark.createDataFrame([(5, Decimal(1)), (6, Decimal(100))], "product_code int, product_price decimal(10,2)")
    run = F.lit(dt.datetime(2021, 1, 1)).cast("timestamp_ntz")
    known = batches.last_known_price(goods, got, got.where("false"), run)
    assert rows(known, "goods_code", "cost_price") == [(5, Decimal("4.0000")), (6, Decimal("62.0000"))]


def test_period_of_a_financial_month_start(spark):
    data = [(dt.date(2020, 1, 30), dt.date(2020, 1, 26)), (dt.date(2020, 2, 25), dt.date(2020, 1, 26)),
            (dt.date(2020, 2, 26), dt.date(2020, 2, 26)), (dt.date(2020, 2, 27), dt.date(2020, 2, 26))]
    finance = spark.createDataFrame(data, "date date, begin_date date")
    got = {r["a"]: (r["b"], r["bn"]) for r in batches.batch_numbers(batches.period_of(finance), finance, "P").collect()}
    assert got[dt.date(2020, 2, 26)] == (dt.date(2020, 1, 26), "P20200226")
    assert got[dt.date(2020, 2, 27)] == (dt.date(2020, 2, 26), "P20200226")


def test_author_names_stay_in_order(spark):
    names = ["b", "a", None, "ab", "aa", "é", "张三", "a"]
    one = {
        "skus": ([(1, "b", "n", Decimal(1), 1, 0)], "sku_code int, bar_code string, sku_name string, price decimal(5,2), spu_code int, content_type int"),
        "spus": ([(1, 2, "c", "t", "l", 1, "s", dt.datetime(2020, 1, 1))], "spu_code int, supplier_code int, background_category_code string, territory_code string, start_flow_location string, goods_index int, spu_status string, create_time timestamp_ntz"),
        "spu_authors": ([(1, i) for i in range(len(names))], "spu_code int, author_code int"),
        "authors": (list(enumerate(names)), "author_code int, author_name string"),
        "suppliers": ([(2, "s")], "supplier_code int, supplier_name string"),
        "categories": ([("c", "C")], "category_code string, category_name string"),
        "territories": ([("t", "T")], "territory_code string, territory_name string"),
        "spu_brands": ([(1, 3, "line")], "spu_code int, brand_code int, brand_line_name string"),
        "brands": ([(3, "B")], "brand_code int, brand_name string"),
    }
    frames = {k: spark.createDataFrame(d, s) for k, (d, s) in one.items()}
    got = dimensions.product_wide(**frames).first()
    assert got["author_name"] == ",".join(sorted(n for n in names if n))
    frames["authors"] = frames["authors"].withColumn("author_name", F.lit(None).cast("string"))
    assert dimensions.product_wide(**frames).first()["author_name"] is None


def test_month_to_date_resets_with_the_month(spark):
    daily = spark.createDataFrame(
        [(dt.date(2020, 1, 30), 1, 1, 5), (dt.date(2020, 1, 31), 1, 1, 6), (dt.date(2020, 2, 1), 1, 1, 7)],
        "create_time date, station_code int, cargo_code int, dailyusage_amount int",
    )
    finance = spark.createDataFrame(
        [(dt.date(2020, 1, 30), dt.date(2020, 1, 1)), (dt.date(2020, 1, 31), dt.date(2020, 1, 1)), (dt.date(2020, 2, 1), dt.date(2020, 2, 1))],
        "date date, begin_date date",
    )
    got = consumption.month_to_date(daily, finance)
    assert rows(got, "monthlyaccumulationusage_amount") == [(11,), (5,), (7,)]


def test_stock_columns_default_to_zero(spark):
    sale = spark.createDataFrame([(1, 1, 5), (1, 2, 6)], "station_code int, product_code int, sale_amount int")
    held = spark.createDataFrame([(1, 1, 3, 4)], "station_code int, product_code int, local_stock_amount int, on_storage_stock_amount int")
    got = sales.emphasis_with_stock(sale, held)
    assert rows(got, "product_code", "local_stock_amount", "on_storage_stock_amount") == [(1, 3, 4), (2, 0, 0)]


def test_catalogue_and_audit(spark):
    df = spark.range(5)
    known = {"goods": ["full", "by_id"], "author": ["full"]}
    assert rows(catalog.load(known, "goods", df, df.where("id < 3"))) == [(3,), (4,)]
    assert catalog.load(known, "goods", df, df, mode="full").count() == 5
    with pytest.raises(KeyError):
        catalog.load(known, "nothing", df, df)
    with pytest.raises(ValueError):
        catalog.load(known, "author", df, df, mode="by_id")
    seen, rows_seen = audit.counted(df, "rows of the load")
    seen.write.format("noop").mode("overwrite").save()
    assert rows_seen.get["rows"] == 5


def test_big_range_tables_are_not_broadcast(spark, monkeypatch):
    events = spark.range(1, 401).selectExpr("'f' AS file", "id AS line_no")
    ranges = spark.range(40).selectExpr("'f' AS file", "id * 10 + 1 AS start_line", "id * 10 + 10 AS end_line")
    monkeypatch.setattr(dayruns, "RANGE_BUCKET", 7)
    for limit in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        assert dayruns.in_ranges(events, ranges).count() == 400
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
