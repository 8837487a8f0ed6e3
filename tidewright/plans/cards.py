"""Stored-value card marts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import money_band
from ..functions.dates import on_days
from ..operators.skew import split_join

Day = dt.date | None
# Card trade types and the state of a finished trade.
RECHARGE_TYPES = (
    "Recharge", "RechargeAdjustAdd", "RechargeAdjustReduce", "RechargeRefund", "RechargeRollback",
)
CONSUME_TYPES = (
    "CardConsume", "CardConsumeRefund", "Consume", "ConsumeAdjustAdd", "ConsumeAdjustReduce",
    "ConsumeRefund",
)
CONSUMED, CONSUME_BACK = ("CardConsume", "Consume"), ("CardConsumeRefund", "ConsumeRefund")
DONE = "Succeed"
# Dates standing for "never" and "before the first proper recharge".
NEVER, ABNORMAL = "2099-01-01 00:00:00", "1990-01-01 00:00:00"


def recharges(trades: DataFrame) -> DataFrame:
    return trades.where(F.col("trade_type").isin(*RECHARGE_TYPES) & (F.col("status") == DONE))


def recharge_consume(trades: DataFrame, first: Day = None, last: Day = None) -> DataFrame:
    """Recharge and consumption money and net counts per day, station, operator and card.

    One pass over the trades; the only join finds the original of each roll-back or refund, which
    must have the same amount and not be of a later day.
    """
    kind, done = F.col("trade_type"), F.col("status") == DONE
    recharge = kind.isin(*RECHARGE_TYPES) & done
    consume = kind.isin(*CONSUME_TYPES)
    undo_recharge = (kind == "RechargeRollback") & done
    undo_consume = kind.isin(*CONSUME_BACK)
    original = trades.where(((kind == "Recharge") & done) | kind.isin(*CONSUMED)).select(
        F.col("trade_number").alias("parent_trade_number"),
        F.col("trade_amount"),
        F.when(kind == "Recharge", "recharge").otherwise("consume").alias("_side"),
        F.to_date("create_time").alias("_original_day"),
    )
    wanted = trades.where(on_days(F.col("create_time"), first, last) & (recharge | consume))
    backs = wanted.where(undo_recharge | undo_consume).select(
        "parent_trade_number",
        "trade_amount",
        F.when(undo_recharge, "recharge").otherwise("consume").alias("_side"),
        F.to_date("create_time").alias("date"),
        "station_code", "operator_code", "card_number",
    )
    keys = ["date", "station_code", "operator_code", "card_number"]
    returned = (
        split_join(backs, original, ["parent_trade_number", "trade_amount", "_side"])
        .where(F.col("_original_day") <= F.col("date"))
        .groupBy(*keys)
        .agg(
            F.count(F.when(F.col("_side") == "recharge", 1)).alias("_recharge_back"),
            F.count(F.when(F.col("_side") == "consume", 1)).alias("_consume_back"),
        )
    )
    flag, zero = F.col("in_out_flag"), F.lit(0)

    def total(test, money):
        return F.coalesce(F.sum(F.when(test, flag * F.col(money))), zero)

    made = (
        wanted.groupBy(F.to_date("create_time").alias("date"), *keys[1:])
        .agg(
            total(recharge, "pay_amount").alias("recharge_realmoney"),
            total(recharge, "trade_amount").alias("recharge_totalmoney"),
            F.count(F.when((kind == "Recharge") & done, 1)).alias("_recharges"),
            (-total(consume, "pay_amount")).alias("consume_realmoney"),
            (-total(consume, "trade_amount")).alias("consume_totalmoney"),
            F.count(F.when(kind.isin(*CONSUMED), 1)).alias("_consumes"),
        )
    )
    both = made.unionByName(returned, allowMissingColumns=True)

    def net(column):
        return F.coalesce(F.sum(column), zero)

    return both.groupBy(*keys).agg(
        net("recharge_realmoney").alias("recharge_realmoney"),
        net("recharge_totalmoney").alias("recharge_totalmoney"),
        (net("_recharges") - net("_recharge_back")).alias("recharge_count"),
        net("consume_realmoney").alias("consume_realmoney"),
        net("consume_totalmoney").alias("consume_totalmoney"),
        (net("_consumes") - net("_consume_back")).alias("consume_count"),
    )


def first_recharge(
    trades: DataFrame, known: DataFrame, first: Day = None, last: Day = None
) -> DataFrame:
    """First proper recharge time of cards not known yet; an earlier other credit marks it."""
    kind = F.col("trade_type")
    credit = (F.col("status") == DONE) & (F.col("in_out_flag") == 1)
    proper = credit & (kind == "Recharge") & (F.col("pay_amount") > 0)
    other = credit & (kind != "Recharge") & (F.col("balance") > 0)
    never = F.lit(NEVER).cast("timestamp_ntz")
    times = (
        trades.where(on_days(F.col("create_time"), first, last) & (proper | other))
        .groupBy("card_number")
        .agg(
            F.coalesce(F.min(F.when(proper, F.col("create_time"))), never).alias("_proper"),
            F.coalesce(F.min(F.when(other, F.col("create_time"))), never).alias("_other"),
        )
    )
    fresh = times.join(known.select("card_number").distinct(), "card_number", "left_anti")
    return fresh.select(
        "card_number",
        F.when(F.col("_proper") <= F.col("_other"), F.col("_proper"))
        .otherwise(F.lit(ABNORMAL).cast("timestamp_ntz"))
        .alias("first_recharge_datetime"),
    )


def _per_card(trades: DataFrame, first: Day, last: Day, band: F.Column, name: str) -> DataFrame:
    flag = F.col("in_out_flag")
    return (
        recharges(trades)
        .where(on_days(F.col("create_time"), first, last))
        .groupBy(
            F.to_date("create_time").alias("date"), "station_code", band.alias(name), "card_number"
        )
        .agg(
            F.sum(flag).alias("recharge_count"),
            F.sum(flag * F.col("trade_amount")).alias("recharge_totalmoney"),
            F.sum(flag * F.col("pay_amount")).alias("recharge_realmoney"),
        )
        .where(F.col("recharge_realmoney") != 0)
    )


def _per_class(cards: DataFrame, card_info: DataFrame, name: str) -> DataFrame:
    measures = ["recharge_count", "recharge_totalmoney", "recharge_realmoney"]
    # Cards are already one row per day, station and band, so no card is hot here.
    return (
        cards.join(card_info.select("card_number", "card_class"), "card_number")
        .groupBy("date", "station_code", name, "card_class")
        .agg(
            F.count("card_number").alias("card_count"), *[F.sum(m).alias(m) for m in measures]
        )
    )


def denomination(
    trades: DataFrame, card_info: DataFrame, first: Day = None, last: Day = None
) -> DataFrame:
    """Cards sold per exact face value and card class, with the band of the value."""
    cards = _per_card(trades, first, last, F.col("pay_amount"), "trade_amount")
    amount = F.col("trade_amount")
    return _per_class(cards, card_info, "trade_amount").withColumn(
        "realmoney_range", money_band(amount, below=amount.cast("string"))
    )


def denomination_range(
    trades: DataFrame, card_info: DataFrame, first: Day = None, last: Day = None
) -> DataFrame:
    """Cards sold per face-value band and card class; a value under the first band counts in the
    last one."""
    band = money_band(F.col("pay_amount"), below=F.lit("5000+"))
    cards = _per_card(trades, first, last, band, "trade_amount_range")
    return _per_class(cards, card_info, "trade_amount_range")
