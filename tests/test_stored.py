"""Stored tables: appended logs, carried values, snapshots, buckets, partitions, merges and loads."""

import datetime as dt
import glob
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidewright.operators.bitmaps import daily_bitmaps, distinct_over
from tidewright.operators.carry import carry_forward, last_known
from tidewright.operators.lineage import reachable, reachable_by_doubling
from tidewright.operators.loglines import parse_events, with_pipeline
from tidewright.plans import shortage, stock, stockdays
from tidewright.plans.dailylog import LogStore
from tidewright.sources.appended import LogIndex
from tidewright.sources.bucketed import join_bucketed, store_bucketed
from tidewright.sources.daytable import DayTable
from tidewright.sources.footers import footer_bounds, newer_than_stored
from tidewright.sources.merge import merge_days
from tidewright.sources.staged import Refused, StagedTable
from tidewright.sources.textlog import read_log

D = dt.date


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


# ---- growing logs ---------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_appended_lines_have_the_numbers_of_one_full_read(spark, tmp_path, seed):
    rng = random.Random(seed)
    logs, index = tmp_path / "logs", LogIndex(spark, f"file://{tmp_path}/index")
    logs.mkdir()
    got = {}
    for _ in range(4):
        before = {f.name: f.stat().st_size for f in logs.iterdir()}
        for name in rng.sample(["a.log", "b.log", "c.log"], rng.randint(0, 3)):
            end = rng.choice(["\n", "\r\n"])
            with open(logs / name, "a", encoding="utf-8", newline="") as file:
                file.write("".join("é" * rng.randint(0, 30) + end for _ in range(rng.randint(1, 200))))
        taken = index.take(f"file://{logs}", block_bytes=rng.randint(50, 900), batch_bytes=rng.choice([64, 1 << 20]))
        for file, start, _, first in taken.planned:  # only what is new is opened
            assert first == before.get(os.path.basename(file), 0) <= start
        for r in taken.lines.collect():
            name = r["file"].rsplit("/", 1)[1]
            assert (name, r["line_no"]) not in got
            got[name, r["line_no"]] = r["value"]
        taken.commit()
    full = {(r["file"].rsplit("/", 1)[1], r["line_no"]): r["value"] for r in read_log(spark, str(logs)).collect()}
    assert got == full
    again = index.take(f"file://{logs}")
    assert again.planned == [] and again.lines.count() == 0


def test_an_unfinished_line_waits_and_an_uncommitted_run_is_made_again(spark, tmp_path):
    log = tmp_path / "run.log"
    index = LogIndex(spark, f"file://{tmp_path}/index")
    log.write_text("one\ntwo\nthr")
    assert [r["value"] for r in index.take(str(log)).lines.orderBy("line_no").collect()] == ["one", "two"]
    first = index.take(str(log))  # nothing was committed
    assert (first.run, first.lines.count()) == (0, 2)
    first.commit()
    log.write_text("one\ntwo\nthree\n")
    second = index.take(str(log))
    assert [(r["line_no"], r["value"]) for r in second.lines.collect()] == [(3, "three")]
    second.commit()
    assert {r["run"] for r in index.blocks().collect()} == {0, 1}
    log.write_text("new\n")
    with pytest.raises(ValueError, match="shorter"):
        index.take(str(log))


LOG = """2020/01/02 03:00:00 - a - Dispatching started for transformation [a]
2020/01/02 03:00:01 - read.0 - linenr 1
stack line
2020/01/02 03:00:02 - b - 为了转换解除补丁开始  [b]
2020/01/02 03:00:03 - read.0 - Finished processing (I=1, O=0, R=0, W=1, U=0, E=0)
"""


def test_a_store_goes_on_with_the_pipeline_that_was_running(spark, tmp_path):
    log = tmp_path / "run.log"
    lines = LOG.splitlines(keepends=True)
    store = LogStore(spark, f"file://{tmp_path}/store")
    assert store.take(str(log)) == [] and store.events.count() == 0
    log.write_text("".join(lines[:2]))
    assert len(store.take(str(log))) == 1
    log.write_text("".join(lines))
    assert [(a, first) for _, a, _, first in store.take(str(log))] == [(len("".join(lines[:2])),) * 2]
    assert store.take(str(log)) == []
    got = sorted((r["line_no"], r["run"], r["pipeline"], r["step"]) for r in store.events.collect())
    assert got == [(1, 0, "a", "a"), (2, 0, "a", "read"), (3, 1, "a", None), (4, 1, "b", "b"), (5, 1, "b", "read")]


@pytest.mark.parametrize("width", [1, 50])
def test_carried_values(spark, width):
    rng = random.Random(width)
    rows, want = [], {}
    for file in ("x", "y"):
        last = "old" if file == "x" else None
        for n in sorted(rng.sample(range(1, 400), 150)):
            value = rng.choice([None, None, None, f"{file}{n}"])
            rows.append((file, n, value))
            last = value or last
            want[file, n] = last
    lines = spark.createDataFrame(rows, "file string, line_no long, v string").repartition(4)
    before = spark.createDataFrame([("x", "old"), ("z", "other")], "file string, held string")
    got = carry_forward(lines, F.col("v"), "held", before, block_lines=width)
    assert {(r["file"], r["line_no"]): r["held"] for r in got.collect()} == want
    ends = {f: want[f, max(n for g, n in want if g == f)] for f in ("x", "y")}
    assert {r["file"]: r["held"] for r in last_known(got, "held").collect()} == ends


def test_steps_belong_to_the_pipeline_that_runs(spark):
    lines = spark.createDataFrame([("f", n, x) for n, x in enumerate(LOG.splitlines(), 1)], "file string, line_no long, value string")
    got = with_pipeline(parse_events(lines))
    assert [r["pipeline"] for r in got.orderBy("line_no").collect()] == ["a", "a", "a", "b", "b"]


# ---- lineage --------------------------------------------------------------------------


def test_doubling_finds_what_a_search_finds(spark):
    rng = random.Random(7)
    pairs = {(f"n{rng.randrange(40)}", f"n{rng.randrange(40)}") for _ in range(60)} | {("n1", "n1")}
    edges = spark.createDataFrame([("g", *p) for p in pairs], "g string, parent string, child string")
    roots = spark.createDataFrame([("g", "n1"), ("g", "n2")], "g string, node string")
    rows = lambda df: sorted(map(tuple, df.select("g", "node", "depth").collect()))
    assert rows(reachable_by_doubling(edges, roots, keys=("g",))) == rows(reachable(edges, roots, keys=("g",)))


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    from tidewright.operators import lineage

    written = []
    keep = lineage.materialise
    monkeypatch.setattr(lineage, "materialise", lambda df, label: written.append(label) or keep(df, label))
    edges = spark.range(260).selectExpr("id AS parent", "IF(id = 259, 0, id + 1) AS child")
    roots = spark.createDataFrame([(0,)], "node long")
    got = reachable_by_doubling(edges, roots)
    assert {r["node"]: r["depth"] for r in got.collect()} == {n: n for n in range(260)}
    assert sum(x.startswith("doubling") for x in written) <= 11


# ---- stock ----------------------------------------------------------------------------


def movements(seed):
    rng = random.Random(seed)
    keys = [("B1", g, s, "NORMAL") for g in range(4) for s in range(2)]
    rows = []
    for b, g, s, bay in keys:
        for _ in range(rng.randint(0, 25)):
            day = D(2020, 1, 1) + dt.timedelta(days=rng.randrange(120))
            rows.append((b, g, s, bay, rng.choice(["IN_STORAGE", "OUT_STORAGE"]), rng.randint(1, 9), dt.datetime(day.year, day.month, day.day, 12)))
    now = {k: rng.choice([0, 5, 40]) for k in keys}
    return keys, rows, now


@pytest.mark.parametrize("seed", [1])
@pytest.mark.parametrize("first,last", [(D(2020, 2, 3), D(2020, 2, 20)), (D(2020, 3, 31), D(2020, 4, 10)), (D(2020, 1, 31), D(2020, 1, 31))])
def test_stock_from_a_snapshot_is_the_back_rolled_stock(spark, tmp_path, seed, first, last):
    keys, rows, now = movements(seed)
    ledger = spark.createDataFrame(
        rows, "batch_no string, goods_code long, from_location_code long, from_location_storage string,"
        " bill_purpose string, amount int, create_time timestamp_ntz")  # fmt: skip
    held = spark.createDataFrame([(*k, v, 1.0, 1.0) for k, v in now.items()], "batch_no string, goods_code long, location_code long,"
                                 " storage string, available_amount long, price double, flow_price double")
    batches = spark.createDataFrame([("B1", g, 1, 2.0) for g in range(4)], "batch_no string, goods_code long, supplier_code long, cost_price double")
    today = D(2020, 5, 31)
    folder = f"file://{tmp_path}/snapshots"
    stockdays.write_snapshots(held, ledger, folder, [D(2020, 1, 31), D(2020, 3, 31)], today)
    stockdays.write_snapshots(held, ledger, folder, [D(2020, 4, 30)], today)
    assert stockdays.snapshot_days(spark, folder) == [D(2020, 1, 31), D(2020, 3, 31), D(2020, 4, 30)]
    got = stockdays.stock_from_snapshot(folder, ledger, held, batches, first, last)
    want = {}
    for k in keys:
        for offset in range((last - first).days + 1):
            day = first + dt.timedelta(days=offset)
            later = sum((1 if r[4] == "IN_STORAGE" else -1) * r[5] for r in rows if r[:4] == k and r[6].date() > day)
            if now[k] - later:
                want[day, *k] = now[k] - later
    assert {(r["date"], r["batch_no"], r["product_code"], r["station_code"], r["storage"]): int(r["amount"]) for r in got.collect()} == want
    rolled = stock.back_rolled_stock(held, ledger, batches, first, last)
    assert sorted(map(str, rolled.select(*got.columns).collect())) == sorted(map(str, got.collect()))


def test_the_ledger_is_read_between_snapshot_and_days_only(spark, tmp_path):
    _, rows, _ = movements(5)
    path = f"file://{tmp_path}/ledger"
    spark.createDataFrame(
        rows, "batch_no string, goods_code long, from_location_code long, from_location_storage string,"
        " bill_purpose string, amount int, create_time timestamp_ntz").write.parquet(path)  # fmt: skip
    ledger = spark.read.parquet(path)
    folder = f"file://{tmp_path}/snapshots"
    held = spark.createDataFrame([("B1", 0, 0, "NORMAL", 4)], "batch_no string, goods_code long, location_code long, storage string, available_amount long")
    stockdays.write_snapshots(held, ledger, folder, [D(2020, 2, 1)], D(2020, 5, 31))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    for span, bounds in (((D(2020, 2, 10), D(2020, 2, 12)), ("2020-02-02", "2020-02-13")), ((D(2020, 1, 10), D(2020, 1, 12)), ("2020-01-11", "2020-02-02"))):
        plan = plan_of(stockdays.stock_stretches(folder, ledger, *span))
        pushed = [x for x in plan.splitlines() if "PushedFilters" in x and "create_time" in x]
        assert f"GreaterThanOrEqual(create_time,{bounds[0]}" in pushed[0] and f"LessThan(create_time,{bounds[1]}" in pushed[0]


@pytest.mark.parametrize("sale_type", [None, "x"])
def test_trailing_sales_of_all_days_are_those_of_each_day(spark, sale_type):
    rng = random.Random(3)
    rows = [
        (1, 1, rng.randrange(3), D(2020, 1, 1) + dt.timedelta(days=rng.randrange(150)), rng.randint(1, 9), rng.choice([1, -1]),
         rng.choice(["SALE", "SALE", "PRESENT"]), rng.choice("xy"))
        for _ in range(120)
    ]
    changes = spark.createDataFrame(
        rows, "station_code int, supplier_code int, product_code int, date date, amount int, in_out_flag int, bill_type string, sale_type string"
    )
    every = stockdays.trailing_sales_all_days(changes, sale_type).cache()
    for day in (D(2019, 12, 31), D(2020, 1, 1), D(2020, 2, 15), D(2020, 4, 9), D(2020, 6, 30), D(2020, 9, 1)):
        one = shortage.trailing_sales(changes, day, sale_type)
        got = stockdays.on_day(every, day)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, one.select(*got.columns).collect()), key=str)


# ---- buckets, partitions, footers -----------------------------------------------------


def test_bucketed_tables_meet_without_an_exchange(spark, tmp_path):
    rng = random.Random(2)
    rows = [(1, "a", n) if n % 3 == 0 else (rng.randrange(50), rng.choice("abc"), n) for n in range(3000)]
    facts = spark.createDataFrame(rows, "k int, l string, n int")
    lookup = spark.createDataFrame([(k, c, k * 10) for k in range(0, 50, 2) for c in "abc"] + [(1, "a", 7)], "k int, l string, v int")
    names = (f"f_{uuid.uuid4().hex}", f"l_{uuid.uuid4().hex}")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = store_bucketed(facts, lookup, ["k", "l"], 8, names, f"file://{tmp_path}")
        assert stored[0].where("k = 1 AND l = 'a'").select("_slice").distinct().count() > 30
        for how in ("inner", "left"):
            got = join_bucketed(*stored, ["k", "l"], how)
            assert "Exchange" not in plan_of(got)
            want = facts.join(lookup, ["k", "l"], how)
            assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def test_days_of_a_catalogue_table(spark, tmp_path):
    day = lambda n: D(2020, 1, n)
    rows = spark.createDataFrame([(day(n % 6 + 1), n) for n in range(60)], "log_date date, n int")
    table = DayTable(spark, f"d_{uuid.uuid4().hex}", "t", f"file://{tmp_path}/db")
    table.create(rows)
    table.reload(rows, day(1), day(6))
    kept = set(glob.glob(f"{tmp_path}/db/t/log_date=2020-01-01/*.parquet"))
    table.reload(rows.where("n >= 30 AND log_date <> DATE'2020-01-03'"), day(2), day(4))
    assert table.days() == {day(n) for n in (1, 2, 4, 5, 6)}
    assert set(glob.glob(f"{tmp_path}/db/t/log_date=2020-01-01/*.parquet")) == kept
    assert spark.table(table.name).count() == 10 + 5 + 5 + 20
    spark.createDataFrame([(day(n), n > 4) for n in range(1, 7)], "day date, done boolean").write.parquet(f"file://{tmp_path}/days")
    got = table.of_days(spark.read.parquet(f"file://{tmp_path}/days").where("NOT done AND day < DATE'2020-02-01'"))
    assert "dynamicpruning" in plan_of(got)
    assert {r["log_date"] for r in got.collect()} == {day(1), day(2), day(4)}


def test_marks_come_from_footers(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(1000).selectExpr("id", "CAST(id AS DOUBLE) / 7 AS x", "DATE'2020-01-01' + CAST(id AS INT) AS d").repartition(5).write.parquet(path)
    bounds = footer_bounds(spark, path, ["id", "d"])
    assert "PushedAggregation: [COUNT(*), MIN(id), MAX(id), MIN(d), MAX(d)]" in plan_of(bounds)
    assert tuple(bounds.first()) == (1000, 0, 999, D(2020, 1, 1), D(2022, 9, 26))
    source = spark.range(990, 1010)
    assert [r["id"] for r in newer_than_stored(source, path, "id").orderBy("id").collect()] == list(range(1000, 1010))
    spark.range(0).write.parquet(f"file://{tmp_path}/none")
    assert newer_than_stored(source, f"file://{tmp_path}/none", "id", floor=1005).count() == 4


# ---- writing back and publishing ------------------------------------------------------


def test_merge_touches_only_the_days_it_must(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = [(D(2020, 1, d), k, None if k == 2 else f"s{k}", 0) for d in (1, 2, 3) for k in (1, 2, 3)]
    spark.createDataFrame(rows, "date date, k int, s string, v long").write.partitionBy("date").parquet(path)
    files = lambda d: sorted(glob.glob(f"{tmp_path}/t/date=2020-01-0{d}/*.parquet"))
    before = {d: files(d) for d in (1, 2, 3)}
    changed = [(D(2020, 1, 2), 2, None, 7), (D(2020, 1, 2), 9, "new", 8), (D(2020, 1, 3), 1, "s1", None)]
    updates = spark.createDataFrame(changed, "date date, k int, s string, v long")
    assert merge_days(path, updates, ["k", "s"], ["v"]) == [D(2020, 1, 2), D(2020, 1, 3)]
    got = {(r["date"].day, r["k"]): r["v"] for r in spark.read.parquet(path).collect()}
    assert got == {(d, k): 0 for d in (1, 2, 3) for k in (1, 2, 3)} | {(2, 2): 7, (3, 1): None}
    assert files(1) == before[1] and files(2) != before[2] and files(3) != before[3]
    with pytest.raises(ValueError, match="more than one update"):
        merge_days(path, updates.unionByName(updates), ["k", "s"], ["v"])
    assert merge_days(path, updates.limit(0), ["k", "s"], ["v"]) == []


def test_a_refused_load_leaves_the_table(spark, tmp_path):
    table = StagedTable(spark, f"file://{tmp_path}", "t")
    source = spark.range(100).selectExpr("id", "IF(id % 10 = 0, NULL, id % 10 > 3) AS good")
    at = dt.datetime(2020, 1, 1)
    counts = table.load(source, F.col("good"), at)
    assert (counts.read, counts.rejected, counts.written) == (100, 40, 60)
    with pytest.raises(Refused):
        table.load(source.where("id < 50"), F.col("good"), at, gate=lambda c: c.written > 40)
    assert table.read().count() == 60 and table.versions() == [0]
    assert not glob.glob(f"{tmp_path}/t/staging-*")
    table.load(source.where("id < 20"), F.lit(True), at)
    assert table.read().count() == 20 and table.versions() == [0, 1]
    got = sorted((r["version"], r["rows_read"], r["rows_rejected"], r["rows_written"], r["published"]) for r in table.audits().collect())
    assert got == [(0, 100, 40, 60, True), (1, 20, 0, 20, True), (1, 50, 20, 30, False)]


def test_bitmaps_merge_to_distinct_counts(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), D(2020, 1, rng.randint(1, 9)), rng.choice([None, *range(40), 100_000, 200_000, -5])) for _ in range(400)]
    table = spark.createDataFrame(rows, "k string, date date, id long")
    bitmaps = daily_bitmaps(table, ["k"], "id")
    for first, last in ((D(2020, 1, 1), D(2020, 1, 9)), (D(2020, 1, 3), D(2020, 1, 4))):
        got = {r["k"]: r["n"] for r in distinct_over(bitmaps, ["k"], "n", first, last).collect()}
        assert got == {k: len({i for x, d, i in rows if x == k and first <= d <= last and i is not None}) for k in "ab"}
