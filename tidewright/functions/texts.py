"""Step names, paths, finish-line counters and text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words a step prints on its last line, in both log languages.
FINISH_WORDS = ("完成处理", "Finished processing")
# Counter letters in printed order.
COUNTERS = ("I", "O", "R", "W", "U", "E")
_COUNTER_TEXT = r"\(\s*" + r"\s*,\s*".join(rf"{c}=(\d+)" for c in COUNTERS) + r"\s*\)"


def step_name(step: Column) -> Column:
    """Step without its copy number and without blanks; digits inside the name stay."""
    return F.translate(F.regexp_replace(F.trim(step), r"\.\d+$", ""), " ", "")


def step_copy(step: Column) -> Column:
    return F.regexp_extract(F.trim(step), r"\.(\d+)$", 1).try_cast("int")


def counters(detail: Column) -> dict[str, Column]:
    """The six row counters of a finish line as longs; zeros for every other line."""
    finished = F.lit(False)
    for word in FINISH_WORDS:
        finished = finished | F.contains(detail, F.lit(word))
    return {
        name: F.coalesce(
            F.when(finished, F.regexp_extract(detail, _COUNTER_TEXT, i + 1).try_cast("long")),
            F.lit(0).cast("long"),
        )
        for i, name in enumerate(COUNTERS)
    }


def counters_text(detail: Column) -> Column:
    """The same six counters joined by commas."""
    return F.concat_ws(",", *[c.cast("string") for c in counters(detail).values()])


def number_text_diff(a: Column, b: Column) -> Column:
    """``b - a`` for two numeric texts; zero when either side is missing or not a number."""
    return F.coalesce(
        b.try_cast("long") - a.try_cast("long"), F.lit(0).cast("long")
    )


def child_file(path: Column) -> Column:
    """File name of a ``folder/file`` entry; null when the path has no or several separators."""
    parts = F.split(F.trim(path), "/")
    return F.when(F.size(parts) == 2, F.nullif(F.get(parts, F.lit(1)), F.lit("")))


def strip_marks(text: Column) -> Column:
    """Drop tab, line feed, carriage return, double quote and backslash."""
    return F.translate(text, "\t\n\r\"\\", "")


def code_prefix(code: Column, width: int) -> Column:
    """First ``width`` characters, or null when the code is shorter."""
    return F.when(F.length(code) >= width, F.left(code, F.lit(width)))
