"""Day windows, verdicts, error tails and step metrics of parsed log events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import materialise
from ..functions.dates import duration_seconds, duration_text
from ..functions.texts import counters
from .loglines import BENIGN_ERRORS, error_lines
from .skew import split_join

SUCCESS, FAILED, NOT_EXECUTED = "success", "failed", "not_executed"

# Lines per equi-join bucket of a line-range join, at every size.
RANGE_BUCKET = 1_000_000


def day_windows(events: DataFrame, marker: str) -> DataFrame:
    """(file, day, start_line, end_line): from the first marked line of the day, or its first
    dated line when none is marked, to its last dated line."""
    marked = F.when(F.contains(F.col("detail"), F.lit(marker)), F.col("line_no"))
    return (
        events.where(F.col("ts").isNotNull())
        .groupBy("file", F.to_date("ts").alias("day"))
        .agg(
            F.coalesce(F.min(marked), F.min("line_no")).alias("start_line"),
            F.max("line_no").alias("end_line"),
        )
    )


def day_bounds(events: DataFrame) -> DataFrame:
    """(file, day, start_line, end_line) from first to last dated line of each day."""
    return (
        events.where(F.col("ts").isNotNull())
        .groupBy("file", F.to_date("ts").alias("day"))
        .agg(F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line"))
    )


def within_span(events: DataFrame, ranges: DataFrame) -> DataFrame:
    """Lines between the first start and the last end of all ranges.

    Two numbers reach the driver; as plain bounds they reach the scan, which skips the row groups
    of lines that no range can have.
    """
    span = ranges.agg(F.min("start_line").alias("a"), F.max("end_line").alias("b")).first()
    if span["a"] is None:
        return events.limit(0)
    return events.where(F.col("line_no").between(span["a"], span["b"]))


def in_ranges(
    events: DataFrame, ranges: DataFrame, bucket: int | None = None, written: bool = False
) -> DataFrame:
    """Join lines to (file, start_line, end_line, …) ranges that contain them.

    Lines and ranges meet on (file, line bucket) of fixed width, so one huge file is spread over
    many tasks and a line is tested against the ranges of its own bucket only.  The ranges are a
    small table of files times days; they are written once (``written``: they come from a table),
    so Spark knows their bytes and broadcasts them below its own limit.
    """
    if not written:
        ranges = materialise(ranges, "line-ranges")
    width = bucket or RANGE_BUCKET
    covered = ranges.withColumn(
        "_bucket",
        F.explode(
            F.sequence(
                F.floor(F.col("start_line") / F.lit(width)),
                F.floor(F.col("end_line") / F.lit(width)),
            )
        ),
    )
    return (
        within_span(events, ranges)
        .withColumn("_bucket", F.floor(F.col("line_no") / F.lit(width)))
        .join(covered, ["file", "_bucket"])
        .where(F.col("line_no").between(F.col("start_line"), F.col("end_line")))
        .drop("_bucket")
    )


def verdicts(
    events: DataFrame,
    windows: DataFrame,
    benign: Sequence[str] = BENIGN_ERRORS,
    bucket: int | None = None,
) -> DataFrame:
    """(file, day, start_line, end_line, first_error, n_errors, status) for each window."""
    keys = ["file", "day"]
    windows = materialise(windows, "day-windows")
    failing = (
        in_ranges(error_lines(events, benign).select("file", "line_no"), windows, bucket, written=True)
        .groupBy(*keys)
        .agg(F.min("line_no").alias("first_error"), F.count(F.lit(1)).alias("n_errors"))
    )
    return windows.join(failing, keys, "left").select(
        *keys,
        "start_line",
        "end_line",
        "first_error",
        F.coalesce("n_errors", F.lit(0)).alias("n_errors"),
        F.when(F.col("first_error").isNull(), SUCCESS).otherwise(FAILED).alias("status"),
    )


def error_tail(events: DataFrame, days: DataFrame, bucket: int | None = None) -> DataFrame:
    """Every line from a failed day's first error to the end of the day."""
    tails = days.where(F.col("status") == FAILED).select(
        "file", "day", "status", F.col("first_error").alias("start_line"), "end_line"
    )
    return in_ranges(events, tails, bucket).select(
        "file", "day", "line_no", F.col("raw").alias("detail"), "status"
    )


def archive(
    events: DataFrame,
    bucket: int | None = None,
    days: DataFrame | None = None,
    dated: DataFrame | None = None,
) -> DataFrame:
    """Every non-blank line between the first and last dated line of a day, text unchanged.

    With ``days`` (day) only those days are kept, and only their ranges meet the log; ``dated``
    are then the events that may have such a day, where the caller can read fewer.
    """
    bounds = day_bounds(events if dated is None else dated)
    if days is not None:
        bounds = bounds.join(days, "day", "left_semi")
    return in_ranges(events, bounds, bucket).select(
        "file", F.col("day").alias("log_date"), "line_no", F.col("raw").alias("detail"), "ts"
    )


def step_metrics(
    events: DataFrame, details: bool = False, also_by: Sequence[str] = ()
) -> DataFrame:
    """Per file, day and step: first and last time, duration and the last line's row counters.

    Counters are numbers before they are aggregated, so the aggregate stays a hash aggregate;
    ``details`` adds the first and last detail text, which makes it a sort aggregate.  ``also_by``
    are further columns to group by, such as the pipeline that wrote a line.
    """
    texts = [
        F.min_by("detail", "line_no").alias("first_detail"),
        F.max_by("detail", "line_no").alias("last_detail"),
    ]
    ends = (
        events.where(F.col("ts").isNotNull())
        .groupBy("file", F.to_date("ts").alias("day"), *also_by, "step")
        .agg(
            F.min("ts").alias("min_ts"),
            F.max("ts").alias("max_ts"),
            *[
                F.max_by(value, "line_no").alias(f"rows_{name.lower()}")
                for name, value in counters(F.col("detail")).items()
            ],
            *(texts if details else []),
        )
    )
    seconds = duration_seconds(F.col("min_ts"), F.col("max_ts"))
    return ends.withColumns(
        {"duration_seconds": seconds, "duration_text": duration_text(seconds)}
    )


def join_lineage(
    metrics: DataFrame, lineage: DataFrame, pipeline: str | None = None
) -> DataFrame:
    """Metrics of the steps that are a lineage source, with the pipeline they belong to.

    ``pipeline`` names a column both sides have where the log tells which pipeline wrote a line
    (``loglines.with_pipeline``); without it a step name used in several pipelines counts for each.
    """
    keys = ["step"] if pipeline is None else ["step", pipeline]
    flows = lineage.withColumnRenamed("from_table", "step")
    return split_join(metrics, flows, keys).withColumnRenamed("step", "from_table")


def log_days(events: DataFrame) -> DataFrame:
    """The distinct days of dated lines."""
    return (
        events.where(F.col("ts").isNotNull()).select(F.to_date("ts").alias("day")).distinct()
    )


def status_rows(days: DataFrame, found: DataFrame, events: DataFrame) -> DataFrame:
    """One row per wanted day; a day without any log line was not executed.

    A failed day carries number and text of its first error line, by file name where several
    files have one.
    """
    per_day = found.groupBy("day").agg(
        F.max(F.when(F.col("status") == FAILED, 1).otherwise(0)).alias("_failed"),
        F.min(F.when(F.col("first_error").isNotNull(), F.struct("file", "first_error"))).alias("_at"),
    )
    texts = events.select(
        F.col("file").alias("_file"), F.col("line_no").alias("_line"), F.col("raw").alias("detail")
    )
    wanted = days.join(per_day, "day", "left")
    # Few days meet many lines: the days are the side that is matched.
    errors = texts.join(
        wanted.where(F.col("_at").isNotNull()).select("day", F.col("_at.file").alias("_file"), F.col("_at.first_error").alias("_line")),
        ["_file", "_line"],
    ).select("day", "detail")
    return wanted.join(errors, "day", "left").select(
        "day",
        F.col("_at.first_error").alias("line_no"),
        "detail",
        F.when(F.col("_failed").isNull(), NOT_EXECUTED)
        .when(F.col("_failed") == 1, FAILED)
        .otherwise(SUCCESS)
        .alias("status"),
    )
