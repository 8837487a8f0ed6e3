"""Stock queries move the ledger and the stock no more often than they must."""

import datetime as dt
import random
import re
from types import SimpleNamespace

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidewright.operators import skew
from tidewright.plans import shortage, stock, stockdays, suppliers
from tidewright.registry import stored
from tidewright.registry.common import plain

D = dt.date
LEDGER = (
    "batch_no string, goods_code long, from_location_code long, from_location_storage string, bill_purpose string,"
    " bill_type string, bill_code long, amount int, inflow_price decimal(12,2), outflow_price decimal(12,2),"
    " origin_system string, create_time timestamp_ntz, update_time timestamp_ntz, stock_date timestamp_ntz"
)
STOCK = (
    "batch_no string, goods_code long, location_code long, storage string, price decimal(12,2),"
    " flow_price decimal(16,4), available_amount long"
)


def noon(day):
    return dt.datetime(day.year, day.month, day.day, 12)


@pytest.fixture(scope="module")
def facts(spark):
    """Ledger, stock and batches with null and repeated keys and keys that only one of them has."""
    rng = random.Random(11)
    keys = [(f"B{b}", g, s, bay) for b in (1, 2) for g in (1, 2, None) for s in (1, 2, None) for bay in ("NORMAL", None)]
    moves = [
        (*rng.choice(keys), rng.choice(["IN_STORAGE", "OUT_STORAGE"]), rng.choice(["SALE", "PRESENT"]), rng.randrange(6),
         rng.randint(1, 9), None, 2, rng.choice(["YH", "ERP"]), *[noon(D(2020, 1, 1) + dt.timedelta(days=rng.randrange(40)))] * 3)
        for _ in range(300)
    ]
    held = [(*k, 3, 2, rng.choice([None, 0, 5, -4, 40])) for k in keys[:-4] for _ in range(rng.randint(1, 2))]
    batches = [("B1", 1, 7, 2), ("B1", 2, 8, 1), ("B2", 1, 7, 4), ("B2", 1, 9, 5), ("B2", None, 7, 1)]
    return (
        spark.createDataFrame([Row(*m) for m in moves], LEDGER.replace("decimal(12,2)", "int")),
        spark.createDataFrame(held, STOCK.replace("decimal(12,2)", "int").replace("decimal(16,4)", "int")),
        spark.createDataFrame(batches, "batch_no string, goods_code long, supplier_code long, cost_price int"),
        moves, held, batches,
    )


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_PART", 1.0)  # few rows, so any key would be hot
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", plan)]


def per_key(held):
    return held.groupBy(*stock.STOCK_KEYS).agg(
        F.max("price").alias("price"), F.max("flow_price").alias("flow_price"), F.sum("available_amount").alias("available_amount")
    )


def test_back_rolled_stock_with_odd_keys(facts):
    ledger, held, batches, moves, stock_rows, batch_rows = facts
    first, last = D(2020, 1, 20), D(2020, 1, 24)
    want = []
    for b, g, s, bay, price, flow, _ in stock_rows:
        if None in (g, s, bay):
            continue
        now = sum(r[6] for r in stock_rows if r[:4] == (b, g, s, bay) and (r[6] or 0) > 0)
        for offset in range(5):
            day = first + dt.timedelta(days=offset)
            later = sum((1 if m[4] == "IN_STORAGE" else -1) * m[7] for m in moves if m[:4] == (b, g, s, bay) and m[11].date() > day)
            want += [
                (day, b, supplier, g, s, bay, now - later, price, flow, cost)
                for x, y, supplier, cost in batch_rows if (x, y) == (b, g) and now != later
            ]
    for by in ((), ("product_code",)):
        got = stock.back_rolled_stock(held, ledger, batches, first, last, by=by)
        assert got.schema["amount"].dataType.simpleString() == "decimal(38,2)"
        assert sorted((*r[:6], int(r["amount"]), *r[7:]) for r in got.collect()) == sorted(want)


def test_stock_is_moved_once_and_days_are_written_last(spark, facts, no_broadcast):
    ledger, held, batches, *_ = facts
    products = spark.createDataFrame([(1, "c", "new"), (2, "c", "old")], "product_code long, category_two_name string, product_state string")
    place = spark.createDataFrame([(1, 5, "five"), (2, 5, "five")], "new_station_code long, logistic_code long, logistics_name string")
    names = spark.createDataFrame([(7, "seven")], "supplier_code long, supplier_name string")
    daily = stock.back_rolled_stock(per_key(held), ledger, batches, D(2020, 1, 20), D(2020, 1, 24), by=["product_code"])
    found = shuffles(daily)
    # movements to key and day, then to their key; stock to its key; both to the batch, then by product
    assert len(found) == 6 and found.count("batch_no, goods_code") == 2
    sums = daily.groupBy("date", "station_code", "product_code").agg(F.sum("amount"))
    assert shuffles(sums) == found  # (day, station, product) are not moved again
    got = suppliers.supplier_stock(daily, products, place, names)
    assert not [x for x in shuffles(got) if x.startswith("date, station_code")]


@pytest.mark.parametrize("least", [2, 100])
def test_days_of_a_month_are_written_after_all_moves(facts, no_broadcast, monkeypatch, least):
    ledger, held, batches, *_ = facts
    batches = batches.withColumn("cost_price", F.when(F.col("cost_price") >= least, F.col("cost_price")))
    month = D(2020, 1, 20), D(2020, 1, 24)
    monkeypatch.setattr(stored, "MONTH", month)
    got = stored.stock_backroll_month(SimpleNamespace(stock=held, ledger=ledger, batches=batches))
    assert not [x for x in shuffles(got) if re.search(r"\bdate\b", x)]
    amount = F.col("amount")
    want = plain(
        stock.back_rolled_stock(held, ledger, batches, *month).groupBy("date", "station_code", "storage").agg(
            F.count(F.lit(1)).alias("n"), F.sum(amount).alias("amount"),
            F.sum(amount * F.col("price")).alias("money"), F.sum(amount * F.col("cost_price")).alias("cost"),
        )
    )
    assert got.schema.simpleString() == want.schema.simpleString()
    rows = sorted(map(str, got.collect()))
    assert rows == sorted(map(str, want.collect())) and len(rows) > 5
    assert ("cost=None" in rows[0]) == (least == 100)  # nothing to add up


def test_unchanged_stock_is_stored_once_for_many_days(spark, tmp_path):
    days = [D(2020, m, 1) for m in range(1, 13)]
    ledger = spark.createDataFrame([("B1", 1, 1, "NORMAL", "IN_STORAGE", 4, noon(D(2020, 5, 5)))], (
        "batch_no string, goods_code long, from_location_code long, from_location_storage string, bill_purpose string,"
        " amount int, create_time timestamp_ntz"))  # fmt: skip
    held = spark.createDataFrame([("B1", g, 1, "NORMAL", 4 + g) for g in (1, 2)] + [("B1", 2, 1, "NORMAL", 1)], (
        "batch_no string, goods_code long, location_code long, storage string, available_amount long"))
    folder = f"file://{tmp_path}/snapshots"
    today = D(2020, 12, 31)
    stockdays.write_snapshots(held, ledger, folder, days, today)
    assert sum(len(spark.read.parquet(f"file://{p}").collect()) for p in tmp_path.glob("snapshots/rows-*")) == 3

    def amounts(day):
        return {r["goods_code"]: int(r["amount"]) for r in stockdays.read_snapshot(spark, folder, day).collect()}

    before = {d: amounts(d) for d in days}
    assert before == {d: {1: 1 if d < D(2020, 5, 5) else 5, 2: 7} for d in days}
    # one of the days is written anew from other stock; a day between two others is added
    other = held.withColumn("available_amount", F.col("available_amount") * 10)
    stockdays.write_snapshots(other, ledger, folder, [days[3], D(2020, 4, 15)], today)
    assert amounts(days[3]) == amounts(D(2020, 4, 15)) == {1: 46, 2: 70}
    assert {d: amounts(d) for d in days if d != days[3]} == {d: v for d, v in before.items() if d != days[3]}
    assert stockdays.snapshot_days(spark, folder) == sorted([*days, D(2020, 4, 15)])


def combined(spark, folder, ledger, held, batches, *span):
    """The job on stored tables, so that filters show at the scans."""
    lines = ledger.select("bill_code", "create_time").where("bill_code < 4").distinct()
    tables = {
        "ledger": ledger, "stock": per_key(held), "batches": batches,
        "papers": lines.selectExpr("bill_code", "create_time", "bill_code % 2 AS origin_bill_code"),
        "orders": spark.createDataFrame([(0, "x"), (1, "y")], "sale_order_code long, sale_type string").join(
            ledger.select("create_time").distinct()),
        "gifts": spark.createDataFrame([(0, None, "a"), (1, 0, None), (2, 9, None)], "code long, related_bill_code long, describe_des string"),
        "center": lines.where("bill_code = 2"),
        "lines": ledger.selectExpr("bill_code % 2 AS sale_order_code", "goods_code AS product_code", "create_time").where("product_code = 1"),
    }
    for name, table in tables.items():
        table.write.mode("ignore").parquet(f"{folder}/{name}")
        tables[name] = spark.read.parquet(f"{folder}/{name}")
    t = tables
    return stock.stock_change_combined(
        t["ledger"], t["batches"], t["stock"], t["papers"], t["orders"], t["gifts"], t["center"], t["lines"], "given", *span
    )


def test_change_rows_are_not_computed_to_count_keys(spark, tmp_path, facts, no_broadcast, monkeypatch):
    counted = []
    keep = skew._count_hot

    def count(df, keys):
        counted.append(df.select(*keys)._jdf.queryExecution().optimizedPlan().toString())
        return keep(df, keys)

    monkeypatch.setattr(skew, "_FOUND", {})
    monkeypatch.setattr(skew, "_count_hot", count)
    rows = combined(spark, f"file://{tmp_path}", *facts[:3]).collect()
    assert counted and not [x for x in counted if "cost_price" in x]
    assert len(rows) > 20 and {r["present_reason"] for r in rows} == {"a", "given", stock.SALE_GIFT, None}


def test_gift_lines_are_known_before_rows_are_moved(spark, tmp_path, facts, no_broadcast):
    folder = f"file://{tmp_path}"
    got = combined(spark, folder, *facts[:3])
    assert not [x for x in shuffles(got) if "product_code" in x]
    for name in ("ledger", "stock", "batches", "papers", "orders", "gifts", "center", "lines"):
        spark.read.parquet(f"{folder}/{name}").createOrReplaceTempView(f"plain_{name}")
    want = spark.sql(f"""
        SELECT p.origin_bill_code AS bill_code, to_date(l.create_time) AS date, l.goods_code AS product_code, l.batch_no,
          b.supplier_code, l.from_location_code AS station_code, l.from_location_storage AS storage, l.amount,
          CASE l.bill_purpose WHEN 'IN_STORAGE' THEN 1 WHEN 'OUT_STORAGE' THEN -1 END AS in_out_flag, s.price,
          coalesce(l.inflow_price, l.outflow_price) AS real_price, s.flow_price, b.cost_price, l.bill_type,
          l.bill_code AS offset_bill_code,
          CASE WHEN l.origin_system = 'YH' THEN l.update_time ELSE l.create_time END AS create_time, o.sale_type,
          coalesce(nvl2(g.describe_des, g.describe_des, h.describe_des), c.given, w.given) AS present_reason
        FROM plain_ledger l
        JOIN plain_papers p ON p.bill_code = l.bill_code AND to_date(p.create_time) = to_date(l.create_time)
        JOIN plain_stock s ON s.batch_no = l.batch_no AND s.goods_code = l.goods_code
          AND s.location_code = l.from_location_code AND s.storage = l.from_location_storage
        JOIN plain_batches b ON b.batch_no = l.batch_no AND b.goods_code = l.goods_code
        LEFT JOIN plain_orders o ON o.sale_order_code = p.origin_bill_code AND to_date(o.create_time) = to_date(l.create_time)
        LEFT JOIN plain_gifts g ON g.code = l.bill_code LEFT JOIN plain_gifts h ON h.code = g.related_bill_code
        LEFT JOIN (SELECT DISTINCT bill_code, to_date(create_time) AS d, 'given' AS given FROM plain_center) c
          ON c.bill_code = l.bill_code AND c.d = to_date(l.create_time)
        LEFT JOIN (SELECT DISTINCT sale_order_code AS o, to_date(create_time) AS d, product_code, '{stock.SALE_GIFT}' AS given FROM plain_lines) w
          ON w.o = p.origin_bill_code AND w.d = to_date(l.create_time) AND w.product_code = l.goods_code""")
    rows = sorted(map(str, got.collect()))
    assert got.columns == want.columns and rows == sorted(map(str, want.collect())) and len(rows) > 20


def test_documents_of_other_days_stay_out(spark, tmp_path, facts):
    folder, (first, last) = f"file://{tmp_path}", (D(2020, 1, 10), D(2020, 1, 14))
    whole, span = combined(spark, folder, *facts[:3]), combined(spark, folder, *facts[:3], first, last)
    want = whole.where(F.col("date").between(F.lit(first), F.lit(last)))
    assert sorted(map(str, span.collect())) == sorted(map(str, want.collect()))
    plan = span._jdf.queryExecution().optimizedPlan().toString()
    bounded = [x for x in plan.splitlines() if "Filter" in x and "2020-01-10" in x]
    assert len(bounded) == 5  # ledger, papers, orders, center gifts, gift lines


def test_filtered_changes_do_not_move_valued_stock(spark, facts, no_broadcast):
    ledger, held, batches, *_ = facts
    got = stock.stock_change_center(ledger, batches, per_key(held)).where("bill_type = 'SALE'")
    found = shuffles(got)
    # ledger and stock to their key, the rows found and the batches to the batch
    assert len(found) == 4 and found.count("batch_no, goods_code") == 2


def test_changes_go_straight_to_their_product(spark, facts, no_broadcast):
    ledger, held, batches, *_ = facts
    products = spark.createDataFrame([(1, *"abcdefgh"), (2, *"abcdefgh"), (2, *"abcdefgh")], ["product_code", *stock.PRODUCT_NAMES])
    bays = spark.createDataFrame([("NORMAL", "n")], "storage_code string, storage_name string")
    changes = stock.stock_change_center(ledger, batches, held).drop("bill_code")
    scanned = ledger.select(F.col("goods_code").alias("product_code"))
    plainly = stock.book_stock_change(changes, products, bays)
    straight = stock.book_stock_change(changes, products, bays, keys_of=scanned)
    assert sorted(map(str, straight.collect())) == sorted(map(str, plainly.collect()))
    assert [x for x in shuffles(plainly) if x.startswith("date")]
    assert not [x for x in shuffles(straight) if x.startswith("date")]


def test_shortage_days_are_those_of_the_change_rows(facts, no_broadcast):
    ledger, held, batches, *_ = facts
    changes = stock.stock_change_center(ledger, batches, held)
    day = D(2020, 1, 30)
    bounded = stock.stock_change_center(ledger, batches, held, day - dt.timedelta(days=59), day)
    got, want = (sorted(map(str, shortage.trailing_sales(c, day).collect())) for c in (bounded, changes))
    assert got == want and got
