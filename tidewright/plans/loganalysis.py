"""The whole daily log analysis; each result is computed when it is asked for."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import materialise
from ..functions.dates import on_days
from ..operators import dayruns
from ..operators.days import days_to_analyse
from ..operators.loglines import BENIGN_ERRORS
from ..sources.tables import full_refresh, reload_days


@dataclass(frozen=True)
class Analysis:
    """Results for all pending days at once.

    ``at`` is the time of analysis; where it is given, every result has it as ``analysis_time``.
    ``written`` says that ``events`` come from a table; else they are written when first needed.
    ``attributed`` says that both events and lineage have the ``pipeline`` a line belongs to, so a
    step counts only for the pipeline that ran it.

    The steps read the events of the pending days only: bounds on time and line number reach the
    scan of the table.
    """

    parsed: DataFrame
    lineage: DataFrame
    done_days: DataFrame
    today: dt.date
    marker: str
    benign: Sequence[str] = BENIGN_ERRORS
    written: bool = False
    at: dt.datetime | None = None
    attributed: bool = False

    @cached_property
    def events(self) -> DataFrame:
        return self.parsed if self.written else materialise(self.parsed, "log-events")

    @cached_property
    def days(self) -> DataFrame:
        return days_to_analyse(self.done_days, self.today).withColumnRenamed("date", "day")

    @cached_property
    def _dated(self) -> DataFrame:
        """Dated lines from the first pending day to the last."""
        span = self.days.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()
        if span["a"] is None:
            return self.events.limit(0)
        return self.events.where(on_days(F.col("ts"), span["a"], span["b"]))

    @cached_property
    def judged(self) -> DataFrame:
        windows = dayruns.day_windows(self._dated, self.marker).join(self.days, "day", "left_semi")
        return materialise(dayruns.verdicts(self.events, windows, self.benign), "day-verdicts")

    def _stamped(self, df: DataFrame) -> DataFrame:
        if self.at is None:
            return df
        return df.withColumn("analysis_time", F.lit(self.at).cast("timestamp_ntz"))

    @cached_property
    def run_status(self) -> DataFrame:
        return self._stamped(dayruns.status_rows(self.days, self.judged, self.events))

    @cached_property
    def error_tail(self) -> DataFrame:
        return self._stamped(dayruns.error_tail(self.events, self.judged))

    @cached_property
    def run_metrics(self) -> DataFrame:
        """Metrics of the good days only: other lines are left out before they are grouped."""
        good = self.judged.where(F.col("status") == dayruns.SUCCESS).select("file", "day")
        lines = self._dated.withColumn("day", F.to_date("ts")).join(good, ["file", "day"], "left_semi")
        by = ["pipeline"] if self.attributed else []
        metrics = dayruns.step_metrics(lines.drop("day"), also_by=by)
        return self._stamped(dayruns.join_lineage(metrics, self.lineage, *by))

    @cached_property
    def archive(self) -> DataFrame:
        return self._stamped(dayruns.archive(self.events, days=self.days, dated=self._dated))

    def store(self, folder: str) -> None:
        """Write lineage anew and the pending days of the four result tables; other days stay.

        A repeated run replaces what it wrote before.
        """
        span = self.days.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
        full_refresh(self.lineage, f"{folder}/lineage")
        results = {
            "run_status": (self.run_status, "day"),
            "error_tail": (self.error_tail, "day"),
            "run_metrics": (self.run_metrics, "day"),
            "archive": (self.archive, "log_date"),
        }
        for name, (rows, day) in results.items():
            if span["first"] is not None:
                reload_days(rows, f"{folder}/{name}", span["first"], span["last"], day=day)


def analyse(
    events: DataFrame,
    lineage: DataFrame,
    done_days: DataFrame,
    today: dt.date,
    marker: str,
    benign: Sequence[str] = BENIGN_ERRORS,
    written: bool = False,
    at: dt.datetime | None = None,
    attributed: bool = False,
) -> Analysis:
    """The analysis of parsed ``events`` for the days after the last of ``done_days``."""
    return Analysis(events, lineage, done_days, today, marker, benign, written, at, attributed)
