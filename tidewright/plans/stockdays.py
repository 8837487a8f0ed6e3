"""Stock of any day from stored snapshots, and trailing sales of all days at once."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.codes import storage_sign
from ..functions.dates import on_days
from .ledger import STOCK_KEYS
from .shortage import KEYS, SALES, WINDOWS
from .stock import BATCH_KEYS

_AMOUNT = "decimal(18,2)"
_DAYS = "days"


def _moved(ledger: DataFrame, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """What each stock key gained per day, from ``first`` to ``last``; both bounds reach the scan."""
    gain = (F.col("amount") * storage_sign(F.col("bill_purpose"))).cast(_AMOUNT)
    return (
        ledger.where(on_days(F.col("create_time"), first, last))
        .select(
            "batch_no",
            "goods_code",
            F.col("from_location_code").alias("location_code"),
            F.col("from_location_storage").alias("storage"),
            F.to_date("create_time").alias("day"),
            gain.alias("gain"),
        )
        .groupBy(*STOCK_KEYS, "day")
        .agg(F.sum("gain").alias("gain"))
    )


def _stretches(base: DataFrame, moved: DataFrame, at: dt.date, first: dt.date, last: dt.date) -> DataFrame:
    """(keys, ``from``, ``to``, ``amount``): stock is ``amount`` at the end of each of these days.

    ``base`` is the stock at the end of ``at``, ``moved`` what was gained between it and the days
    asked for: all after it, or all up to it.  A key has one row in ``base`` and one per day in
    ``moved`` at most, and only those pass the window.
    """
    keys, zero = list(STOCK_KEYS), F.lit(0).cast(_AMOUNT)
    day = Window.partitionBy(*keys).orderBy("day")
    if at < first:
        start = base.select(*keys, F.lit(at).alias("day"), F.col("amount").alias("gain"))
        steps = moved.unionByName(start)
        rows = steps.select(
            *keys,
            F.greatest("day", F.lit(first)).alias("from"),
            F.coalesce(F.date_sub(F.lead("day").over(day), 1), F.lit(last)).alias("to"),
            F.sum("gain").over(day.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("amount"),
        )
    else:
        end = base.select(*keys, F.lit(at + dt.timedelta(days=1)).alias("day"), (-F.col("amount")).alias("gain"))
        # What a day gained is undone for the days before it; behind the last gain stands the base.
        steps = moved.unionByName(end)
        later = day.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        rows = steps.select(
            *keys,
            F.coalesce(F.lag("day").over(day), F.lit(first)).alias("from"),
            F.least(F.date_sub("day", 1), F.lit(last)).alias("to"),
            (zero - F.sum("gain").over(later)).alias("amount"),
        )
    rows = rows.withColumns({"from": F.greatest("from", F.lit(first)), "to": F.least("to", F.lit(last))})
    return rows.where((F.col("from") <= F.col("to")) & (F.col("amount") != 0))


def current(stock: DataFrame) -> DataFrame:
    """The stock now, where there is any, one row per key."""
    amount = F.col("available_amount").cast(_AMOUNT)
    return stock.where("available_amount > 0").groupBy(*STOCK_KEYS).agg(F.sum(amount).alias("amount"))


def write_snapshots(
    stock: DataFrame, ledger: DataFrame, folder: str, days: Sequence[dt.date], today: dt.date
) -> None:
    """Store the stock at the end of each of ``days``, one partition per day.

    All snapshots come from the stock at the end of ``today`` and one read of the ledger back to the
    first of them.  Snapshots of other days stay as they are.

    Stock that does not change from one snapshot to the next is stored once, with the first and the
    last of the days at which it holds, so the rows grow with the changes and not with the days.
    The rows of a call lie in a folder of their own, and the partition of a day names that folder;
    it is written last, so a failed call changes no snapshot.  Folders that no day names any more
    are left where they are.
    """
    spark = ledger.sparkSession
    first, last = min(days), max(days)
    moved = _moved(ledger, first + dt.timedelta(days=1), today)
    held = _stretches(current(stock), moved, today, first, last)
    wanted = F.filter(F.array(*map(F.lit, sorted(days))), lambda d: d.between(F.col("from"), F.col("to")))
    rows = f"rows-{uuid.uuid4().hex}"
    held.select(
        *STOCK_KEYS, "amount", F.array_min(wanted).alias("since"), F.array_max(wanted).alias("until")
    ).where(F.col("since").isNotNull()).write.parquet(f"{folder}/{rows}")
    (
        spark.range(1)
        .select(F.lit(rows).alias("rows"), F.explode(F.array(*map(F.lit, sorted(days)))).alias("snapshot_day"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_day")
        .parquet(f"{folder}/{_DAYS}")
    )


def read_snapshot(spark: SparkSession, folder: str, day: dt.date) -> DataFrame:
    """(keys, ``amount``) of the snapshot of a day."""
    rows = spark.read.schema("rows string").parquet(f"{folder}/{_DAYS}/snapshot_day={day}").first()["rows"]
    held = spark.read.parquet(f"{folder}/{rows}")
    return held.where(F.lit(day).between(F.col("since"), F.col("until"))).select(*STOCK_KEYS, "amount")


def snapshot_days(spark: SparkSession, folder: str) -> list[dt.date]:
    """Days that have a snapshot, from the names of the partitions."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = files.globStatus(path(f"{folder}/{_DAYS}/snapshot_day=*")) or []
    return sorted(dt.date.fromisoformat(f.getPath().getName().partition("=")[2]) for f in found)


def nearest(days: Sequence[dt.date], first: dt.date, last: dt.date) -> dt.date:
    """The snapshot from which the fewest days of the ledger lead to all days asked for."""
    return min(days, key=lambda d: (last - d if d < first else max(d, last) - first, d))


def stock_stretches(
    folder: str, ledger: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Stock from ``first`` to ``last`` as stretches of days, rolled from the nearest snapshot.

    A snapshot before the first day is rolled forward, one on or after it back; only the ledger
    between the snapshot and the days asked for is read.
    """
    spark = ledger.sparkSession
    days = snapshot_days(spark, folder)
    usable = [d for d in days if d < first or d >= last]
    if not usable:
        raise ValueError("no snapshot before the first or after the last day")
    at = nearest(usable, first, last)
    base = read_snapshot(spark, folder, at)
    since, until = (at, last) if at < first else (first, at)
    return _stretches(base, _moved(ledger, since + dt.timedelta(days=1), until), at, first, last)


def valued_stretches(
    folder: str, ledger: DataFrame, stock: DataFrame, batches: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Valued stock from ``first`` to ``last`` as stretches of days; stock meets what is held first."""
    prices = stock.select(*STOCK_KEYS, "price", "flow_price")
    cost = batches.select(*BATCH_KEYS, "supplier_code", "cost_price")
    held = stock_stretches(folder, ledger, first, last).join(prices, list(STOCK_KEYS)).join(cost, BATCH_KEYS)
    return held.withColumnsRenamed({"goods_code": "product_code", "location_code": "station_code"})


def stock_from_snapshot(
    folder: str, ledger: DataFrame, stock: DataFrame, batches: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Valued stock at the end of each day from ``first`` to ``last``, non-zero rows only.

    Long stretches become many rows, so they are dealt over all tasks before they are written out.
    """
    held = valued_stretches(folder, ledger, stock, batches, first, last)
    return held.hint("rebalance").select(
        F.explode(F.sequence("from", "to")).alias("date"),
        "batch_no",
        "supplier_code",
        "product_code",
        "station_code",
        "storage",
        "amount",
        "price",
        "flow_price",
        "cost_price",
    )


def trailing_sales_all_days(changes: DataFrame, sale_type: str | None = None) -> DataFrame:
    """Net sales of the last 60, 30, 15 and 7 days for every day, as stretches of equal days.

    (station, supplier, product, ``valid_from``, ``valid_to``, one sum per window): each row holds
    for all days from ``valid_from`` to ``valid_to``; a key has rows while its longest window holds
    a sale, and a window without sales is null, as in ``trailing_sales`` of one day.

    A day's sales enter every window that day and leave a window of n days n days later, so sums
    over windows are running sums of these differences.  Changes are read once and collapse to one
    row per key and day; only five rows for each of those pass the window.
    """
    amount = (-F.col("amount") * F.col("in_out_flag")).cast("long")
    sold = changes.where(F.col("bill_type") == "SALE")
    if sale_type is not None:
        sold = sold.where(F.col("sale_type") == sale_type)
    daily = sold.groupBy(*KEYS, "date").agg(F.sum(amount).alias("a"), F.count(F.lit(1)).alias("c"))
    zero = F.lit(0).cast("long")

    def step(day, windows, sign: int):
        values = [F.col(x) * sign if n in windows else zero for n in WINDOWS for x in ("a", "c")]
        names = [f"{x}{n}" for n in WINDOWS for x in ("a", "c")]
        return F.struct(day.alias("day"), *[v.alias(k) for v, k in zip(values, names)])

    steps = F.array(step(F.col("date"), WINDOWS, 1), *[step(F.date_add("date", n), (n,), -1) for n in WINDOWS])
    names = [f"{x}{n}" for n in WINDOWS for x in ("a", "c")]
    by_day = (
        daily.select(*KEYS, F.explode(steps).alias("s"))
        .select(*KEYS, "s.*")
        .groupBy(*KEYS, "day")
        .agg(*[F.sum(n).alias(n) for n in names])
    )
    day = Window.partitionBy(*KEYS).orderBy("day")
    so_far = day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = by_day.select(
        *KEYS,
        F.col("day").alias("valid_from"),
        F.date_sub(F.lead("day").over(day), 1).alias("valid_to"),
        *[F.sum(n).over(so_far).alias(n) for n in names],
    )
    return sums.where(F.col(f"c{WINDOWS[0]}") > 0).select(
        *KEYS,
        "valid_from",
        "valid_to",
        *[F.when(F.col(f"c{n}") > 0, F.col(f"a{n}")).alias(s) for n, s in zip(WINDOWS, SALES)],
    )


def on_day(stretches: DataFrame, day: dt.date) -> DataFrame:
    """The stretches that cover a day, in the form of one day's trailing sales."""
    return stretches.where(F.lit(day).between(F.col("valid_from"), F.col("valid_to"))).select(*KEYS, *SALES)
