"""Café material consumption and passenger flow."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import split_join

# Visitor field in the older and the newer log system, and the state of a sent log.
OLD_FIELD, NEW_FIELD = "94", "passengerFlow"


def daily_consumption(usage: DataFrame, calendar: DataFrame, after: dt.date | None = None):
    """Material used per day, station and cargo with the calendar's year, month and weekday."""
    if after is not None:
        usage = usage.where(
            F.col("create_time") >= F.lit(after + dt.timedelta(days=1)).cast("timestamp_ntz")
        )
    sums = usage.groupBy(
        F.to_date("create_time").alias("create_date"), "station_code", "cargo_code"
    ).agg(
        F.sum(F.col("cargo_usage_amount") * F.col("in_out_flag")).alias("dailyusage_amount"),
        F.sum(F.col("usage_money") * F.col("in_out_flag")).alias("dailyusage_money"),
    )
    days = calendar.select(
        F.col("date").alias("create_date"),
        F.col("year").alias("create_time_year"),
        F.col("fina_year_month").alias("yearmonth"),
        F.col("weekday_name").alias("create_time_week"),
    )
    return sums.join(days, "create_date").withColumnRenamed("create_date", "create_time")


def month_to_date(daily: DataFrame, finance: DataFrame) -> DataFrame:
    """Each day's use and the running use since its financial month began, for every day at once.

    Input has one row per day, station and cargo, so a window holds one financial month.
    """
    begin = finance.select(F.col("date").alias("create_time"), "begin_date")
    month = (
        Window.partitionBy("station_code", "cargo_code", "begin_date")
        .orderBy("create_time")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return daily.join(begin, "create_time").select(
        "create_time",
        "station_code",
        "cargo_code",
        "dailyusage_amount",
        F.sum("dailyusage_amount").over(month).alias("monthlyaccumulationusage_amount"),
    )


def month_to_date_of(daily: DataFrame, begin: dt.date, day: dt.date) -> DataFrame:
    """The report of one day: also lists what was used this month but not on the day."""
    used = F.col("dailyusage_amount")
    return (
        daily.where(F.col("create_time").between(F.lit(begin), F.lit(day)))
        .groupBy("station_code", "cargo_code")
        .agg(
            F.coalesce(F.sum(F.when(F.col("create_time") == F.lit(day), used)), F.lit(0)).alias(
                "dailyusage_amount"
            ),
            F.sum(used).alias("monthlyaccumulationusage_amount"),
        )
        .withColumn("create_time", F.lit(day))
    )


def passenger_flow(
    stores: DataFrame, notes: DataFrame, values: DataFrame, station_codes: DataFrame,
    bases: DataFrame, fields: DataFrame,
) -> DataFrame:
    """Visitors per day and station from both log systems."""
    visitors = values.where(F.col("field_id") == OLD_FIELD).select("info_id", "info_value")
    old = (
        split_join(notes.where(F.col("info_state") == 1), visitors, ["info_id"])
        .join(stores.select(F.col("store_id").alias("station_id"), "store_number"), "station_id")
        .join(station_codes.select("store_number", "station_code"), "store_number")
        .select(
            F.to_date("record_date").alias("create_time"),
            "station_code",
            F.col("info_value").cast("string").alias("passenger_flow"),
        )
    )
    answers = fields.where(F.col("field_code") == NEW_FIELD).select(
        F.col("info_base_id").alias("id"), "field_value"
    )
    new = (
        split_join(
            bases.where((F.col("log_type") == "DAY") & (F.col("log_status") == "SUBMIT")),
            answers, ["id"], "left",
        )
        .select(
            F.to_date("start_date").alias("create_time"),
            "station_code",
            F.col("field_value").cast("string").alias("passenger_flow"),
        )
    )
    return old.unionByName(new)
