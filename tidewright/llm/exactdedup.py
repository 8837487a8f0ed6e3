"""Exact duplicates by recipes of content-defined chunks; built-in expressions only.

Each normalised text is cut behind every word that, hashed with the word before it, falls on one
value of WORDS: about every 512 characters, and at the same words wherever they stand, so a text
that differs somewhere shares its other chunks.  A chunk is named by a 64-bit hash.  Names are
verified: all chunks of one name must have one SHA-256 and one length; where they have not, those
chunks go by their SHA-256 instead.  A document is then the ordered list of its names, and lists are
grouped.  Only names and digests are shuffled, never texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import materialise
from ..operators.skew import split_join
from .support import BLANKS, text_of

#: One word in so many ends a chunk.
WORDS = 85
# A cut is this letter without its twin behind it; where the text has the letter itself, it gets the twin.
_CUT, _TWIN = "\x01", "\x02"


def recipes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text_sha256`` and ``chunks`` (name, sha, n in order) of every row."""
    normal = docs.select(F.col(id_col).alias("doc_id"), F.regexp_replace(text_of(text), BLANKS, " ").alias("normal"))
    words = F.split(F.replace(F.col("normal"), F.lit(_CUT), F.lit(_CUT + _TWIN)), " ")
    before = F.concat(F.array(F.lit("")), words)
    marked = F.zip_with(
        words, F.slice(before, F.lit(1), F.size(words)),
        lambda word, last: F.when(F.pmod(F.xxhash64(word, last), F.lit(WORDS)) == 0, F.concat(word, F.lit(_CUT))).otherwise(word),
    )
    cut = F.split(F.array_join(marked, " "), f"{_CUT}(?!{_TWIN})")
    return normal.select(
        "doc_id",
        F.sha2(F.col("normal").cast("binary"), 256).alias("text_sha256"),
        F.transform(
            cut,
            lambda c: F.struct(F.xxhash64(c).alias("name"), F.unhex(F.sha2(c, 256)).alias("sha"), F.octet_length(c).alias("n")),
        ).alias("chunks"),
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256`` of every row.

    Texts are equal when they are after each run of blanks became one space.  The row with the
    smallest id of a group stays.  A null text counts as empty, and empty texts are equal.  A null
    id only stands for a group that has no other, and rows that repeat an id all count; those that
    repeat the smallest id all have ``kept`` true, as ids cannot tell them apart.  Only the two named
    columns are read, so others may have any name.  An empty table gives no rows; texts may have any
    length.
    """
    read = materialise(recipes(docs, id_col, text), "recipes")
    chunk = read.select(F.explode("chunks").alias("c")).select("c.*")
    shared = materialise(
        chunk.groupBy("name")
        .agg(F.min("sha").alias("a"), F.max("sha").alias("b"), F.min("n").alias("m"), F.max("n").alias("n"))
        .where((F.col("a") != F.col("b")) | (F.col("m") != F.col("n")))
        .select("name"),
        "doubtful-names",
    )
    shas = F.lit(None).cast("array<binary>")
    listed = read
    if not shared.isEmpty():  # hardly ever: documents that hold a name of several contents go by their digests
        doubtful = (
            read.select("text_sha256", F.explode("chunks").alias("c"))
            .join(shared.select(F.col("name").alias("_name")), F.col("c.name") == F.col("_name"), "left_semi")
            .select("text_sha256")
            .distinct()
            .withColumn("_doubt", F.lit(True))
        )
        listed = read.join(doubtful, "text_sha256", "left")
        shas = F.when(F.col("_doubt"), F.transform("chunks", lambda c: c["sha"]))
    listed = listed.select(
        "doc_id", "text_sha256", F.transform("chunks", lambda c: c["name"]).alias("names"), shas.alias("shas")
    )
    same = F.struct("names", F.coalesce("shas", F.array().cast("array<binary>")).alias("shas"))
    listed = listed.select("doc_id", "text_sha256", same.alias("recipe"))
    groups = listed.groupBy("recipe").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return split_join(listed, groups, ["recipe"]).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


DUPLICATES_SQL = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS normal FROM documents
), grouped AS (
  SELECT doc_id, sha256(normal) AS text_sha256, min(doc_id) OVER (PARTITION BY normal) AS keep_id,
    count(*) OVER (PARTITION BY normal) AS group_size
  FROM normal
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM grouped"""
