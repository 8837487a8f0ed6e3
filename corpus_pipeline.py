"""From raw documents to token ids: five stages, each reads what the one before it kept.

1. ``quality``: rejected documents go.
2. ``exact``: of equal texts the document with the smallest id stays.
3. ``near``: of each group of near duplicates (five words, similarity 0.8) one document stays.
4. ``mix``: each document is repeated as often as the mix takes it, or not at all.
5. ``encode``: token ids, decoded again to prove the round trip.

A stage is a function of (spark, docs, sf_dir); it returns the columns of ``documents``, and the
last one ``doc_id``, ``n_tokens`` and two digests.

Rows may have null ids and share ids: where rows are compared they go by a key of their own, so a
row is kept or dropped for its own text alone.  A null text is empty; of empty texts one stays.  No
stage fails on an empty table or on further columns, which are left out.  Texts may have any length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewright.durable import fresh_folder
from tidewright.llm import bpe, exactdedup, minhash, mixing, quality, tokens
from tidewright.llm.support import with_row_key

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def _only(keyed: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose ``_key`` is among the ids of ``keys``.

    The keys grow with the corpus, so they are merged and not broadcast.
    """
    kept = keys.select(F.col("doc_id").alias("_key")).hint("merge")
    return keyed.join(kept, "_key", "left_semi").select(*DOCUMENT)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labels of the corpus and keeps what the classifier predicts as good."""
    model = quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, model).select(*DOCUMENT)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = with_row_key(docs)
    return _only(keyed, exactdedup.exact_duplicates(keyed, id_col="_key").where("kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    keyed = with_row_key(docs)
    return _only(keyed, minhash.near_duplicates(keyed, width=5, percent=80, id_col="_key").where("kept"))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document taken twice is two rows."""
    return mixing.repeated(docs, mixing.mix(docs)).select(*DOCUMENT)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, tokens.default_path("byte_bpe_50k.json"))


STAGES = [
    ("quality", quality_stage),
    ("exact", exact_stage),
    ("near", near_stage),
    ("mix", mix_stage),
    ("encode", encode_stage),
]

#: Scores, near duplicates, random rounding and token ids are not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
