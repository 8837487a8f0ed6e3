"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..durable import materialise
from ..shipping import ship

# The white space that separates words; everything else belongs to a word.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

_PARTITION_BITS = 33


#: Bytes of one batch that is handed to Python.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession, rows: int = 4096, size: int = BATCH_BYTES) -> None:
    """Hand texts to Python in batches of limited bytes and rows, so that long texts do not add up.

    A text longer than the limit is a batch of its own.
    """
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_of(column: str | Column) -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z lower-cased, every other letter left as it is."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def running_starts(sizes: DataFrame, part: str, size: str, name: str) -> DataFrame:
    """``part`` and ``name``, the sum of ``size`` over all smaller parts.

    ``sizes`` has one row per file or partition, so the window and the broadcast of its result are
    bounded by the list of files that the driver holds anyway.
    """
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(sizes.select(part, F.coalesce(F.sum(size).over(before), F.lit(0)).cast("long").alias(name)))


def with_row_key(docs: DataFrame, id_col: str = "doc_id", key: str = "_key") -> DataFrame:
    """Add ``key``, a whole number of its own for every row, in the order of the ids.

    It is the id itself where every row has one and none repeats.  Else all rows are numbered by
    their ids, null ones last, and equal ids by their place.  Rows are told apart by file and place
    in it; what does not come from Parquet files is written to some first.
    """
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place")]
    docs = docs.drop(key, "_file", "_place")
    try:
        located = docs.select("*", *place)
    except AnalysisException:
        located = materialise(docs, "keyed-rows").select("*", *place)
    own = F.col(id_col).cast("long")
    counts = located.groupBy(own.alias("_id")).agg(F.count(F.lit(1)).alias("_n"))
    if counts.where("_n > 1 OR _id IS NULL").isEmpty():
        return located.withColumn(key, own).drop("_file", "_place")
    rows = located.select(own.isNull().alias("_none"), own.alias("_own"), "_file", "_place")
    fresh, _ = numbered(rows, ["_none", "_own", "_file", "_place"], "fresh-ids")
    found = located.join(fresh.select("_file", "_place", F.col("row").alias(key)), ["_file", "_place"])
    return found.drop("_file", "_place")


def numbered(df: DataFrame, order_by: Sequence[str], label: str) -> tuple[DataFrame, int]:
    """Add ``row``, the global position 0, 1, 2 … in the given order; also returns the row count.

    Rows are range-partitioned, sorted and written once, since bounds come from a sample.  Only
    one count per partition passes the window of offsets.  Rows equal in all ordering columns may take
    each other's numbers.
    """
    placed = materialise(
        df.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_at", F.monotonically_increasing_id()),
        label,
    )
    placed = placed.withColumn("_part", F.shiftright("_at", _PARTITION_BITS))
    sizes = materialise(placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")), f"{label}-sizes")
    local = F.col("_at") - F.shiftleft("_part", _PARTITION_BITS)
    rows = placed.join(running_starts(sizes, "_part", "_n", "_start"), "_part").withColumn("row", local + F.col("_start"))
    return rows.drop("_at", "_part", "_start"), sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
