"""Catalogue tables partitioned by day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class DayTable:
    """A managed Parquet table ``database.name`` with one partition per ``day``.

    The database lies in ``folder``, which all executors must share.
    """

    def __init__(self, spark: SparkSession, database: str, name: str, folder: str, day: str = "log_date") -> None:
        self.spark, self.day = spark, day
        self.name = f"{database}.{name}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{folder}'")

    def create(self, like: DataFrame) -> None:
        """Make the empty table with the columns of ``like``, the day last."""
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema if f.name != self.day]
        kind = like.schema[self.day].dataType.simpleString()
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join([*columns, f'`{self.day}` {kind}'])})"
            f" USING parquet PARTITIONED BY (`{self.day}`)"
        )

    def days(self) -> set[dt.date]:
        """Days that have a partition; the catalogue is asked, no file is opened."""
        rows = self.spark.sql(f"SHOW PARTITIONS {self.name}").collect()
        return {dt.date.fromisoformat(r[0].partition("=")[2]) for r in rows}

    def reload(self, rows: DataFrame, first: dt.date, last: dt.date) -> None:
        """Replace the days from ``first`` to ``last`` by ``rows``; other partitions are not touched.

        Days that get rows are overwritten partition by partition in one commit; those that lose
        all rows are dropped from the catalogue after it, so a failed run can be repeated.
        """
        kept = rows.where(F.col(self.day).between(F.lit(first), F.lit(last)))
        columns = self.spark.table(self.name).columns
        filled = {r[0] for r in kept.select(self.day).distinct().collect()}
        # Writes into catalogue tables take this from the session, not from an option.
        mode = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(mode)
        self.spark.conf.set(mode, "dynamic")
        try:
            kept.select(*columns).hint("rebalance", F.col(self.day)).write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(mode, before)
        emptied = sorted(d for d in self.days() if first <= d <= last and d not in filled)
        if emptied:
            parts = ", ".join(f"PARTITION (`{self.day}` = DATE'{d}')" for d in emptied)
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {parts}")

    def of_days(self, days: DataFrame, column: str = "day") -> DataFrame:
        """Rows of the days in a table of days.

        The days are known only when the query runs: Spark prunes the partitions by them then.
        """
        wanted = days.select(F.col(column).alias(self.day)).distinct()
        return self.spark.table(self.name).join(wanted, self.day, "left_semi")
