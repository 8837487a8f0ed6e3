"""Output shape shared by all checked queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def plain(df: DataFrame, **digits: int) -> DataFrame:
    """Days and times as text, decimals as doubles (rounded first where digits are given)."""
    columns = []
    for field in df.schema.fields:
        name, kind = field.name, field.dataType.typeName()
        column = F.col(name)
        if kind == "date":
            column = F.date_format(column, "yyyy-MM-dd")
        elif kind.startswith("timestamp"):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif kind == "decimal":
            column = (F.round(column, digits[name]) if name in digits else column).cast("double")
        columns.append(column.alias(name))
    return df.select(*columns)
