"""Parsing of run-log lines into typed events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import TS_TEXT, wall_time
from ..functions.texts import step_copy, step_name
from .carry import carry_forward

# The three spellings that mark an error line.
ERROR_SPELLINGS = ("error", "ERROR", "Error")
# Fixed value: lines of this framework component are noise, not failures.
BENIGN_ERRORS = (r"org\.osgi\.service\.cm\.ManagedService",)

# What a pipeline says when it starts, before its name in brackets.
START_PHRASES = ("为了转换解除补丁开始", "Dispatching started for transformation")

_SEPARATOR = " - "
_DATED = f"^{TS_TEXT}{_SEPARATOR}"
_STAMP_WIDTH = len("yyyy/MM/dd HH:mm:ss")
_STEP_AT = _STAMP_WIDTH + len(_SEPARATOR) + 1


def drop_blank(lines: DataFrame) -> DataFrame:
    """Drop empty lines and the word null; line numbers stay the physical ones."""
    return lines.where((F.length("value") > 0) & (F.col("value") != "null"))


def parse_events(lines: DataFrame) -> DataFrame:
    """(file, line_no, ts, step, copy, detail, raw) for each line.

    A dated line is ``timestamp - step.copy - detail``; separators after the second belong to the
    detail.  Every other line keeps its text as detail and has neither time nor step.  Stateless,
    so it works on streaming input as well.
    """
    value = F.col("value")
    # Plain positions instead of a split: the timestamp has a fixed width.
    cut = F.locate(_SEPARATOR, value, _STEP_AT)
    dated = value.rlike(_DATED) & (cut > 0)
    step = F.substr(value, F.lit(_STEP_AT), cut - _STEP_AT)
    kept = [c for c in lines.columns if c != "value"]
    return lines.select(
        *kept,
        F.when(dated, wall_time(F.left(value, F.lit(_STAMP_WIDTH)))).alias("ts"),
        F.when(dated, step_name(step)).alias("step"),
        F.when(dated, step_copy(step)).alias("copy"),
        F.when(dated, F.substr(value, cut + len(_SEPARATOR))).otherwise(value).alias("detail"),
        value.alias("raw"),
    )


def error_lines(events: DataFrame, benign: Sequence[str] = BENIGN_ERRORS) -> DataFrame:
    """Lines spelling an error that no benign pattern covers; stays distributed."""
    spelled = F.lit(False)
    for word in ERROR_SPELLINGS:
        spelled = spelled | F.contains(F.col("raw"), F.lit(word))
    out = events.where(spelled)
    for pattern in benign:
        out = out.where(~F.col("raw").rlike(pattern))
    return out


def started_pipeline(detail: Column, phrases: Sequence[str] = START_PHRASES) -> Column:
    """Name of the pipeline that a line says has started, else null."""
    said = F.regexp_extract(detail, rf"^(?:{'|'.join(phrases)}) +\[(.*)\]$", 1)
    return F.when(said != "", said)


def with_pipeline(events: DataFrame, phrases: Sequence[str] = START_PHRASES) -> DataFrame:
    """Add ``pipeline``: the one whose start is the last before each line of a file, else null."""
    return carry_forward(events, started_pipeline(F.col("detail"), phrases), "pipeline")
