"""Token counts with a cache keyed by content and tokenizer-version digests."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import materialise
from ..operators.skew import split_join
from .support import BLANKS, small_batches, text_of
from .tokens import encoder, release, tokenizer_version

_CACHE = "digest binary, version string, n_tokens long"


def read_cache(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version, one row per content digest; none without a folder."""
    try:
        stored = spark.read.schema(_CACHE).parquet(folder)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        stored = spark.createDataFrame([], _CACHE)
    return stored.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    cache: str,
    by_words: bool = False,
    limit: int = 2048,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row, whole texts.

    Digests of the content join the counts in ``cache``, a folder of Parquet files shared by all
    runs.  Only one document of each digest without a count is encoded; its count is appended.
    With ``by_words`` (the tokenizer ignores the amount of white space) content is normalised by
    replacing each run of blanks by one space, otherwise it is the text itself.

    Null text counts as empty: 0 bytes, and what the tokenizer gives for an empty text.  Rows may
    repeat, ids may be null; every row is returned, an empty table gives none.  Only the two named
    columns are read, so others may have any name; texts may have any length.  Two runs that append the same digest at once
    store it twice, which reading undoes.
    """
    spark = docs.sparkSession
    small_batches(spark)
    version = tokenizer_version(tokenizer)
    whole = text_of(text)
    content = F.regexp_replace(whole, BLANKS, " ") if by_words else whole
    read = docs.select(F.col(id_col).alias("doc_id"), whole.alias("text"), F.unhex(F.sha2(content, 256)).alias("digest"))
    keys = materialise(read.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest"), "token-keys")

    one_each = keys.groupBy("digest").agg(F.min("doc_id").alias("_id"))
    missing = one_each.join(read_cache(spark, cache, version), "digest", "left_anti").withColumnRenamed("digest", "_digest")
    texts = read.join(
        missing, read["doc_id"].eqNullSafe(F.col("_id")) & (read["digest"] == F.col("_digest")), "left_semi"
    ).select("digest", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer, by_words)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codec.count_column(batch.column(1)))], names=["digest", "n_tokens"])
        release()

    counted = texts.mapInArrow(count, "digest binary, n_tokens long")
    counted.select("digest", F.lit(version).alias("version"), "n_tokens").write.mode("append").parquet(cache)
    return split_join(keys, read_cache(spark, cache, version), ["digest"], "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
