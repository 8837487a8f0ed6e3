"""Token-id files: Parquet with one list of ids per document, readable document by document."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import running_starts, small_batches, text_of
from .tokens import encoder, release

_FILE = "doc_id long, part int, local_start long, n_tokens int, ids array<int>"


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    by_words: bool = False,
    encoding: str = "dictionary",
    row_group_bytes: int = 32 << 20,
    page_rows: int = 4096,
    id_col: str = "doc_id",
    text: str = "text",
) -> None:
    """Write ids of whole texts, ``end_id`` appended to each, in ascending id order over all files.

    Columns: ``doc_id``, ``part`` (number of the file), ``local_start`` (ids before it in its
    file), ``n_tokens`` (with the end id) and ``ids``.  ``encoding`` "dictionary" keeps the ids as
    bit-packed dictionary indexes, "delta" as packed differences; the other numbers are delta
    coded.  Row groups are limited in bytes and pages in rows, and the writer adds page indexes,
    so a reader that asks for some documents or for counts only reads those pages.

    A null text is written as the end id alone, a null id stands first, rows with equal ids follow
    the hash of their text.  Only the two named columns are read, so others may have any name; an
    empty table gives files without rows, and a text of any length is one row.  Texts are range-partitioned by id before they are encoded, so each is
    encoded once and a lost task is simply run again.
    """
    small_batches(docs.sparkSession)
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text).alias("text"))
        .withColumn("_tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "_tie")
        .sortWithinPartitions("doc_id", "_tie")
        .drop("_tie")
    )

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start = TaskContext.get().partitionId(), 0
        codec = encoder(tokenizer, by_words)
        for batch in batches:
            ids, counts = codec.encode_column(batch.column(1))
            counts = counts + 1
            ends = np.cumsum(counts)
            values = np.full(len(ids) + len(counts), end_id, dtype="<i4")
            own = np.ones(len(values), dtype=bool)
            own[ends - 1] = False
            values[own] = ids
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(values))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(counts), part, dtype=np.int32)), pa.array(start + ends - counts),
                 pa.array(counts.astype(np.int32)), lists],
                names=["doc_id", "part", "local_start", "n_tokens", "ids"],
            )
            start += int(ends[-1]) if len(ends) else 0
        release()

    by_dictionary = {"parquet.enable.dictionary": "false", "parquet.enable.dictionary#ids.list.element": "true"}
    ordered.mapInArrow(coded, _FILE).write.mode("error").options(
        **{
            "compression": "zstd",
            "parquet.writer.version": "v2",
            "parquet.block.size": str(row_group_bytes),
            "parquet.page.row.count.limit": str(page_rows),
            **(by_dictionary if encoding == "dictionary" else {"parquet.enable.dictionary": "false"}),
        }
    ).parquet(folder)


def read_token_files(spark: SparkSession, folder: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``.

    With ``doc_ids`` only those documents are read: files, row groups and pages that cannot hold
    one of them are skipped by their bounds.  Starts come from the counts alone, whose columns are
    a small part of a file.
    """
    files = spark.read.schema(_FILE).parquet(folder)
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    wanted = files if doc_ids is None else files.where(F.col("doc_id").isin(list(doc_ids)))
    return wanted.join(running_starts(totals, "part", "n", "_before"), "part").select(
        "doc_id",
        (F.col("local_start") + F.col("_before")).alias("start"),
        F.col("n_tokens").cast("long").alias("n_tokens"),
        "ids",
    )


def with_checksums(tokens: DataFrame) -> DataFrame:
    """Add ``ids_crc32``, the checksum of the ids as little-endian unsigned 32-bit integers."""
    small_batches(tokens.sparkSession)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            values = lists.values.to_numpy().astype("<u4")
            places = lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(places[:-1], places[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums, pa.int64())], names=[*batch.schema.names, "ids_crc32"]
            )

    return tokens.mapInArrow(summed, "doc_id long, start long, n_tokens long, ids array<int>, ids_crc32 long")
