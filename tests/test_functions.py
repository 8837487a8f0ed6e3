import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewright.functions import codes, dates, sqlnames, texts


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()], F.lit(1).alias("_"))
    return row.select(column.alias("out")).first()["out"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("2020/01/02 03:04:05", dt.datetime(2020, 1, 2, 3, 4, 5)),
        ("2020/13/02 03:04:05", None),
        ("2020/1/2 03:04:05", None),
        ("noise", None),
        ("", None),
    ],
)
def test_parse_ts_is_strict_and_never_epoch(spark, text, want):
    assert one(spark, dates.parse_ts(F.col("t")), t=text) == want


@pytest.mark.parametrize(
    "seconds, want",
    [
        (0, "0天0小时0分钟0秒钟"),
        (93784, "1天2小时3分钟4秒钟"),
        (-93784, "-1天-2小时-3分钟-4秒钟"),
        (None, None),
    ],
)
def test_duration_text(spark, seconds, want):
    assert one(spark, dates.duration_text(F.lit(seconds).cast("long"))) == want


def test_days_after_excludes_the_first_day_and_may_be_empty(spark):
    a, b = F.lit(dt.date(2020, 1, 30)), F.lit(dt.date(2020, 2, 2))
    assert one(spark, dates.days_after(a, b)) == [
        dt.date(2020, 1, 31), dt.date(2020, 2, 1), dt.date(2020, 2, 2),
    ]
    assert one(spark, dates.days_after(b, b)) == []
    assert one(spark, dates.days_after(b, a)) == []


def test_day_comparisons(spark):
    a, b = F.lit(dt.datetime(2020, 1, 1, 23)), F.lit(dt.datetime(2020, 1, 1, 1))
    assert one(spark, dates.same_day(a, b)) is True
    assert one(spark, dates.not_after(a, b)) is True
    assert one(spark, dates.same_day(F.lit(None).cast("timestamp"), b)) is False
    assert one(spark, dates.day_text(F.lit("2020/01/02 03:04:05"))) == "2020/01/02"


@pytest.mark.parametrize(
    "step, name, copy",
    [
        ("rate_04000-x.0", "rate_04000-x", 0),
        ("MySQL load 400.12", "MySQLload400", 12),
        ("Pan", "Pan", None),
        ("v2.0.1", "v2.0", 1),
    ],
)
def test_step_name_strips_only_the_copy_number(spark, step, name, copy):
    assert one(spark, texts.step_name(F.col("s")), s=step) == name
    assert one(spark, texts.step_copy(F.col("s")), s=step) == copy


@pytest.mark.parametrize(
    "detail, want",
    [
        ("Finished processing (I=1, O=2, R=3, W=4, U=5, E=6)", "1,2,3,4,5,6"),
        ("完成处理 (I=0, O=10, R=10, W=10, U=0, E=0)", "0,10,10,10,0,0"),
        ("完成处理 (I=1, O=2, R=3, W=4, U=5)", "0,0,0,0,0,0"),
        ("linenr 50000", "0,0,0,0,0,0"),
        (None, "0,0,0,0,0,0"),
    ],
)
def test_counters(spark, detail, want):
    assert one(spark, texts.counters_text(F.lit(detail).cast("string"))) == want


def test_small_text_helpers(spark):
    assert one(spark, texts.child_file(F.lit("${dir}/x.ktr"))) == "x.ktr"
    assert one(spark, texts.child_file(F.lit("a/b/x.ktr"))) is None
    assert one(spark, texts.child_file(F.lit("x.ktr"))) is None
    assert one(spark, texts.number_text_diff(F.lit("500"), F.lit("2000"))) == 1500
    assert one(spark, texts.number_text_diff(F.lit("x"), F.lit("2000"))) == 0
    assert one(spark, texts.strip_marks(F.lit('a\tb\nc\rd"e\\f'))) == "abcdef"
    assert one(spark, texts.code_prefix(F.lit("123"), 4)) is None


def test_bands_and_signs(spark):
    def band(x):
        return one(spark, codes.money_band(F.lit(x), below=F.lit("under")))

    assert [band(x) for x in (-1, 0, 199.99, 200, 4999, 5000)] == [
        "under", "0-200", "0-200", "200-300", "3000-5000", "5000+",
    ]

    def hour(h):
        return one(spark, codes.hour_band(F.lit(dt.datetime(2020, 1, 1, h, 59))))

    assert [hour(h) for h in (0, 9, 10, 13, 21, 22, 23)] == [
        "0-10", "0-10", "10-12", "12-14", "20-22", "22-24", "22-24",
    ]
    assert one(spark, codes.order_sign(F.lit("BACK_ORDER"))) == -1
    assert one(spark, codes.storage_sign(F.lit("OTHER"))) == 0
    assert one(spark, codes.signed(F.lit("X"), ["A"], ["B"], None)) is None
    assert one(spark, codes.decode(F.lit("CAFE"), codes.STATION_TYPES)) == "咖啡馆"
    assert one(spark, codes.decode(F.lit("?"), codes.STATION_TYPES)) is None
    assert one(spark, codes.by_prefix(F.lit("签售会"), codes.SALE_TYPES, "D")) == "CHECK_SALES"
    assert one(spark, codes.by_prefix(F.lit(None).cast("string"), codes.SALE_TYPES, "D")) == "D"


def test_sql_names(spark):
    assert len(sqlnames.register(spark)) == len(sqlnames.SQL_FUNCTIONS)
    row = spark.sql(
        "SELECT log_ts('2020/01/02 03:04:05') a, log_day('2020/01/02 03:04:05') b,"
        " same_log_day('2020/01/02', '2020/01/02 10:00:00') c,"
        " log_seconds('2020/01/02 00:01:05', '2020/01/02 00:00:00') d,"
        " number_text_diff('5', '20') e, child_file('${x}/b.ktr') f,"
        " log_counter('Finished processing (I=1, O=2, R=3, W=4, U=5, E=6)', 'W') g,"
        " log_counter('Finished processing (I=1, O=2, R=3, W=4, U=5)', 'W') h"
    ).first()
    assert tuple(row) == (
        dt.datetime(2020, 1, 2, 3, 4, 5), "2020/01/02", True, 65, 15, "b.ktr", 4, 0,
    )


def test_sql_names_say_what_the_column_builders_say(spark):
    """Both forms of every function on the same lines, odd ones included."""
    stamps = ["2020/01/02 03:04:05", " 2020/01/02 03:04:05 ", "2020/13/02 03:04:05", "2020/1/2 3:4:5", "", None, "x y"]
    finish = "{} (I=1, O=22, R=3 , W=4,U=5, E=600)"
    details = [*(finish.format(w) for w in texts.FINISH_WORDS), finish.format("Done"), "Finished processing (I=1)", "", None,
               "Finished processing (I=1, O=2, R=3, W=4, U=5, E=99999999999999999999)"]
    paths = ["${x}/b.ktr", "b.ktr", "a/b/c", "/", "a/", " a/b ", None]
    numbers = ["5", " 7", "x", "", None, "-3"]
    rows = [
        (stamps[i % len(stamps)], stamps[i // 7 % len(stamps)], details[i % len(details)], paths[i % len(paths)],
         numbers[i % len(numbers)], numbers[i // 6 % len(numbers)])
        for i in range(420)
    ]
    table = spark.createDataFrame(rows, "a string, b string, detail string, path string, x string, y string")
    sqlnames.register(spark)
    pairs = {
        "log_ts(a)": dates.parse_ts(F.col("a")),
        "log_day(a)": dates.day_text(F.col("a")),
        "log_seconds(a, b)": dates.duration_seconds(dates.wall_time(F.trim("b")), dates.wall_time(F.trim("a"))),
        "number_text_diff(x, y)": texts.number_text_diff(F.col("x"), F.col("y")),
        "child_file(path)": texts.child_file(F.col("path")),
    }
    pairs |= {f"log_counter(detail, '{n}')": c for n, c in texts.counters(F.col("detail")).items()}
    both = table.select(*[F.struct(F.expr(text).alias("sql"), column.alias("built")) for text, column in pairs.items()])
    for row in both.collect():
        for name, value in zip(pairs, row, strict=True):
            assert value["sql"] == value["built"], name
