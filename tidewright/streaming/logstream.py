"""Parse log lines as files arrive.

Line numbers need whole files, so a stream carries the file name only; day windows and verdicts
stay batch jobs over the archived events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.loglines import drop_blank, parse_events


def stream_events(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    lines = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
        .select(F.col("_metadata.file_path").alias("file"), "value")
    )
    return parse_events(drop_blank(lines))
