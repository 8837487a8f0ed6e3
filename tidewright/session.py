"""Session settings the jobs rely on.  Nothing here starts a session on its own."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings only: no memory, core or master choices, those belong to the cluster.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is split even when the split costs one more exchange above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Sums of products must fail loudly rather than wrap.
    "spark.sql.ansi.enabled": "true",
}

# A task's memory follows the rows it takes at once, so what one task is given stays small at any
# size of the input.  A caller's smaller sizes are kept.
TASK_SIZES = {
    "spark.sql.files.maxPartitionBytes": 32 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 64 << 20,
}
# Pieces a shuffle is cut into before adaptive execution puts small ones together again; with few
# of them a piece of a large table would be over the size above.
PIECES = 1000


def _keep_tasks_small(spark: SparkSession) -> None:
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in TASK_SIZES.items():
        if as_bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    pieces = spark.conf.get(key, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if int(pieces) < PIECES:
        spark.conf.set(key, str(PIECES))


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session the caller owns."""
    _keep_tasks_small(spark)
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark
