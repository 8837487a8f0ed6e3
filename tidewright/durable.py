"""Intermediate tables that survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Folders written by this process, for ``clean``.
_WRITTEN: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without the setting gets a fresh temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so the missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = "file://" + tempfile.mkdtemp(prefix="tidewright-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_folder(spark: SparkSession, label: str) -> str:
    """Name of a new folder in the shared one, for results that a caller writes; ``clean`` removes it."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: lineage ends at the files."""
    spark = df.sparkSession
    path = fresh_folder(spark, label)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> int:
    """Delete the intermediate tables that this process wrote; returns how many.

    Call it when their results have been stored: frames that still read them fail afterwards.
    """
    removed = 0
    while _WRITTEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        removed += bool(files.delete(path, True))
    return removed
