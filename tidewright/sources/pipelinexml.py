"""Pipeline definitions: transformation hops and job entries from XML folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.texts import child_file

_HOP = T.StructType(
    [
        T.StructField("from", T.StringType()),
        T.StructField("to", T.StringType()),
        T.StructField("enabled", T.StringType()),
    ]
)
# Explicit arrays: inference turns a single hop or entry into a struct.
TRANSFORMATION = T.StructType(
    [T.StructField("order", T.StructType([T.StructField("hop", T.ArrayType(_HOP))]))]
)
_ENTRY = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("filename", T.StringType())]
)
JOB = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("entries", T.StructType([T.StructField("entry", T.ArrayType(_ENTRY))])),
    ]
)



def file_name() -> Column:
    """Name of the file a row came from, with the percent escapes of the path undone."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def hops(spark: SparkSession, folder: str) -> DataFrame:
    """(file, from_table, to_table, enabled): one row per hop of every transformation."""
    files = (
        spark.read.format("xml")
        .option("rowTag", "transformation")
        .schema(TRANSFORMATION)
        .load(f"{folder.rstrip('/')}/*.ktr")
    )
    return files.select(
        file_name().alias("file"), F.explode("order.hop").alias("hop")
    ).select(
        "file",
        F.col("hop.from").alias("from_table"),
        F.col("hop.to").alias("to_table"),
        (F.coalesce(F.col("hop.enabled"), F.lit("Y")) == "Y").alias("enabled"),
    )


def job_entries(spark: SparkSession, folder: str) -> DataFrame:
    """(file, entry_name, child): the entries that name both a step and a child file."""
    files = (
        spark.read.format("xml")
        .option("rowTag", "job")
        .schema(JOB)
        .load(f"{folder.rstrip('/')}/*.kjb")
    )
    entries = files.select(
        file_name().alias("file"), F.explode("entries.entry").alias("entry")
    )
    return (
        entries.select(
            "file", F.col("entry.name").alias("entry_name"), F.col("entry.filename").alias("path")
        )
        .dropna()
        .select("file", "entry_name", child_file(F.col("path")).alias("child"))
        .dropna()
    )
