import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewright.operators import dayruns
from tidewright.operators.days import calendar, days_to_analyse, pending_days
from tidewright.operators.loglines import drop_blank, error_lines, parse_events
from tidewright.plans.loganalysis import analyse
from tidewright.sources.textlog import read_log
from tidewright.streaming.logstream import stream_events

MARKER = "[marker]"
LOG = """#####
ERROR: worker lost before the run
2020/01/02 03:00:00 - main - start [marker]
2020/01/02 03:04:05 - read_orders.0 - linenr 50000

2020/01/02 03:05:00 - read_orders.0 - Finished processing (I=10, O=0, R=0, W=10, U=0, E=0)
*ERROR* [org.osgi.service.cm.ManagedService, id=1]: x
2020/01/02 03:05:01 - load_orders.0 - start load - LOAD DATA
2020/01/02 03:05:02 - load_orders.0 - 完成处理 (I=0, O=10, R=10, W=10, U=0, E=0)
2020/01/02 03:05:03 - rate_04000-x.0 - Finished processing (I=1, O=0, R=0, W=1, U=0, E=0)
null
2020/01/03 03:00:00 - main - start [marker]
2020/01/03 03:01:00 - read_orders.0 - linenr 1
Error: disk full
\tat some.Class(File.java:1)
2020/01/03 03:02:00 - main - stopped
2020/13/03 03:02:00 - main - impossible month
2020/01/05 01:00:00 - read_orders.0 - linenr 2
2020/01/05 01:00:01 - read_orders.0 - Finished processing (I=1, O=2, R=3, W=4, U=5)
"""


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("log") / "run.log"
    path.write_text(LOG, encoding="utf-8")
    lines = read_log(spark, str(path))
    return parse_events(drop_blank(lines)).withColumn("file", F.lit("run.log")).cache()


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_physical_numbers_survive_blank_lines(events):
    numbers = [r["line_no"] for r in events.orderBy("line_no").collect()]
    assert numbers == [n for n in range(1, 20) if n not in (5, 11)]


def test_parse_keeps_separators_in_the_detail(events):
    by_line = {r["line_no"]: r for r in events.collect()}
    assert by_line[8]["detail"] == "start load - LOAD DATA"
    assert (by_line[10]["step"], by_line[10]["copy"]) == ("rate_04000-x", 0)
    assert by_line[17]["ts"] is None
    assert by_line[14]["step"] is None and by_line[14]["detail"] == "Error: disk full"
    assert by_line[3]["raw"] == "2020/01/02 03:00:00 - main - start [marker]"


def test_error_lines_skip_the_allowed_component(events):
    assert [n for (n,) in rows(error_lines(events), "line_no")] == [2, 14]
    assert [n for (n,) in rows(error_lines(events, ()), "line_no")] == [2, 7, 14]


def test_windows_start_at_the_first_marker_or_first_dated_line(events):
    assert rows(dayruns.day_windows(events, MARKER), "day", "start_line", "end_line") == [
        (dt.date(2020, 1, 2), 3, 10), (dt.date(2020, 1, 3), 12, 16), (dt.date(2020, 1, 5), 18, 19),
    ]


@pytest.mark.parametrize("bucket", [1, 3, 1_000_000])
def test_verdict_and_tail(events, bucket):
    judged = dayruns.verdicts(events, dayruns.day_windows(events, MARKER), bucket=bucket)
    assert rows(judged, "day", "first_error", "n_errors", "status") == [
        (dt.date(2020, 1, 2), None, 0, "success"),
        (dt.date(2020, 1, 3), 14, 1, "failed"),
        (dt.date(2020, 1, 5), None, 0, "success"),
    ]
    tail = dayruns.error_tail(events, judged, bucket=bucket)
    assert [n for (n,) in rows(tail, "line_no")] == [14, 15, 16]
    kept = dayruns.archive(events, bucket=bucket)
    assert [n for (n,) in rows(kept, "line_no")] == [3, 4, 6, 7, 8, 9, 10, 12, 13, 14, 15, 16, 18, 19]


def test_step_metrics(events):
    out = rows(
        dayruns.step_metrics(events, details=True).where("step <> 'main'"),
        "day", "step", "duration_seconds", "rows_i", "rows_o", "rows_w", "last_detail",
    )
    assert [r[:6] for r in out] == [
        (dt.date(2020, 1, 2), "load_orders", 1, 0, 10, 10),
        (dt.date(2020, 1, 2), "rate_04000-x", 0, 1, 0, 1),
        (dt.date(2020, 1, 2), "read_orders", 55, 10, 0, 10),
        (dt.date(2020, 1, 3), "read_orders", 0, 0, 0, 0),
        (dt.date(2020, 1, 5), "read_orders", 1, 0, 0, 0),
    ]
    assert out[0][6].startswith("完成处理")


def test_analyse_judges_all_pending_days_at_once(spark, events):
    lineage = spark.createDataFrame(
        [("job", "a.ktr", "read_orders", "orders", True)],
        "job_name string, pipeline string, from_table string, to_table string, enabled boolean",
    )
    done = spark.createDataFrame([(dt.date(2020, 1, 1),)], "date date")
    got = analyse(events, lineage, done, dt.date(2020, 1, 5), MARKER)
    assert rows(got.run_status, "day", "status") == [
        (dt.date(2020, 1, 2), "success"), (dt.date(2020, 1, 3), "failed"),
        (dt.date(2020, 1, 4), "not_executed"), (dt.date(2020, 1, 5), "success"),
    ]
    assert rows(got.run_metrics, "day", "to_table", "rows_o") == [
        (dt.date(2020, 1, 2), "orders", 0), (dt.date(2020, 1, 5), "orders", 0),
    ]
    assert got.error_tail.count() == 3
    assert got.archive.count() == 14


def test_day_planning(spark):
    days = calendar(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 6))
    done = spark.createDataFrame([(dt.date(2020, 1, 2),), (None,)], "date date")
    left = pending_days(days, done, after=dt.date(2020, 1, 1), before=dt.date(2020, 1, 6), limit=2)
    assert [r["date"].day for r in left.collect()] == [5, 4]
    assert [r["date"].day for r in days_to_analyse(done, dt.date(2020, 1, 4)).collect()] == [3, 4]
    empty = spark.createDataFrame([], "date date")
    assert [r["date"].day for r in days_to_analyse(empty, dt.date(2020, 1, 4)).collect()] == [4]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_numbering_is_one_to_n_for_any_split(spark, tmp_path, seed):
    rng = random.Random(seed)
    want = {}
    for f in range(3):
        lines = ["x" * rng.randrange(0, 60) + f" {i}" for i in range(rng.randrange(1, 900))]
        (tmp_path / f"l{f}.log").write_text("\n".join(lines) + "\n")
        want[f"l{f}.log"] = lines
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(rng.randrange(600, 5000)))
    try:
        got = {}
        for r in read_log(spark, str(tmp_path)).collect():
            got.setdefault(r["file"].rsplit("/", 1)[1], {})[r["line_no"]] = r["value"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for name, lines in want.items():
        assert got[name] == dict(enumerate(lines, 1))


def test_stream_parses_like_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.log").write_text(LOG, encoding="utf-8")
    query = (
        stream_events(spark, str(source))
        .writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 17
    assert out.where("step = 'read_orders'").count() == 5
