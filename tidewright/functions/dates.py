"""Log timestamps, durations and day arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the only timestamp layout the run log uses.
TS_TEXT = r"\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}"

# Unit words of the duration text, largest unit first.
DURATION_UNITS = (("天", 86400), ("小时", 3600), ("分钟", 60), ("秒钟", 1))


def wall_time(text: Column) -> Column:
    """Text already known to look like a log timestamp; an impossible date is null."""
    return F.translate(text, "/", "-").try_cast("timestamp_ntz")


def parse_ts(text: Column) -> Column:
    """Strict ``yyyy/MM/dd HH:mm:ss`` to a wall-clock timestamp; anything else is null."""
    return F.when(F.trim(text).rlike(f"^{TS_TEXT}$"), wall_time(F.trim(text)))


def format_ts(ts: Column) -> Column:
    return F.date_format(ts, "yyyy/MM/dd HH:mm:ss")


def duration_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def duration_text(seconds: Column) -> Column:
    """Whole seconds as days, hours, minutes and seconds in words; null stays null."""
    parts, rest = [], seconds
    for word, size in DURATION_UNITS:
        count = ((rest - rest % F.lit(size)) / F.lit(size)).cast("long")
        parts += [count.cast("string"), F.lit(word)]
        rest = rest % F.lit(size)
    return F.concat(*parts)


def day_text(text: Column) -> Column:
    """The part of a timestamp text before the first blank."""
    return F.split_part(text, F.lit(" "), F.lit(1))


def same_day(a: Column, b: Column) -> Column:
    return F.coalesce(F.to_date(a) == F.to_date(b), F.lit(False))


def not_after(a: Column, b: Column) -> Column:
    """True when the day of ``a`` is the day of ``b`` or earlier."""
    return F.coalesce(F.to_date(a) <= F.to_date(b), F.lit(False))


def days_after(start: Column, end: Column) -> Column:
    """Array of the days later than ``start`` up to and including ``end``."""
    return F.when(start < end, F.sequence(F.date_add(start, 1), end)).otherwise(
        F.array().cast("array<date>")
    )


def on_days(ts: Column, first: dt.date | None, last: dt.date | None) -> Column:
    """Half-open filter covering whole days; an open side is left out of the predicate.

    Written against the raw timestamp so that it reaches the scan as a pushed filter.
    """
    keep = F.lit(True)
    if first is not None:
        keep = keep & (ts >= F.lit(first).cast("timestamp_ntz"))
    if last is not None:
        keep = keep & (ts < F.lit(last + dt.timedelta(days=1)).cast("timestamp_ntz"))
    return keep
