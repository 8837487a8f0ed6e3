"""One query per operator, over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import fresh_folder
from . import (
    bpe, exactdedup, lattice, minhash, mixing, quality, sharding, tokencounts, tokenfiles, tokens, turns, urlfilter, warc, whitening,
)

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Starts from an empty cache, so every distinct text is encoded."""
    docs = _table(spark, sf_dir, "documents")
    return tokencounts.token_counts(docs, tokens.default_path(WORD_BPE), fresh_folder(spark, "token-cache"), by_words=True)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.learn(docs, _table(spark, sf_dir, "labels"))
    return quality.scored(docs.select("doc_id", "text"), model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urlfilter.judge_urls(_table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "strict_hits", "soft_hits")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), tokens.default_path(BYTE_BPE))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    rows = F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))
    return mixed.withColumn("_row", rows).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"
    )


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_folder(spark, "token-files")
    docs = _table(spark, sf_dir, "documents")
    tokenfiles.write_token_files(docs, folder, tokens.default_path(WORD_BPE), end_id=1, by_words=True)
    return tokenfiles.with_checksums(tokenfiles.read_token_files(spark, folder)).drop("ids")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(_table(spark, sf_dir, "documents"), shards=8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row"
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=16, weigh_by="one")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of their own for records; what the archives say is all that is returned."""
    folder = fresh_folder(spark, "archives")
    warc.write_archives(_table(spark, sf_dir, "pages"), folder, least_bytes=0)
    return warc.page_records(warc.read_archives(spark, folder, with_payload=False))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.damage_and_repair(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_quality": op4_quality,
    "op5_url_filter": op5_url_filter,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_bpe": op7_bpe,
    "op8_mixing": op8_mixing,
    "op9_token_files": op9_token_files,
    "op10_sharding": op10_sharding,
    "op11_whitening": op11_whitening,
    "op12_warc": op12_warc,
    "op13_conversation_repair": op13_conversation_repair,
}

SQL = {
    "op2_exact_dedup": exactdedup.DUPLICATES_SQL,
    "op5_url_filter": urlfilter.judge_sql(),
    "op12_warc": warc.pages_sql(),
}
