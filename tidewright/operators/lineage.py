"""Pipeline lineage: terminal hops, nested jobs and the lineage table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import materialise
from ..sources.pipelinexml import file_name, hops, job_entries

# Fixed value: ending of the name of the step that only signals the end of a job.
SENTINEL = "job_all_succeed"
JOB_SUFFIX, STEP_SUFFIX = ".kjb", ".ktr"


def terminal_hops(all_hops: DataFrame) -> DataFrame:
    """Hops whose target is not the source of another hop in the same file."""
    sources = all_hops.select("file", F.col("from_table").alias("to_table"))
    return all_hops.join(sources, ["file", "to_table"], "left_anti").select(*all_hops.columns)


def reachable(
    edges: DataFrame, roots: DataFrame, keys: tuple[str, ...] = (), max_depth: int | None = None
) -> DataFrame:
    """Nodes reachable from ``roots`` over (parent, child) edges, with the depth of first reach.

    ``keys`` are extra columns that parent and child share.  Each round joins only the newest
    nodes, drops those seen before (so cycles end) and writes the round to the shared folder;
    rounds end when nothing new appears or after ``max_depth`` of them.
    """
    cols = [*keys, "node"]
    step_edges = edges.select(*keys, F.col("parent").alias("node"), "child").distinct()
    newest = materialise(
        roots.select(*cols).distinct().withColumn("depth", F.lit(0)), "reach-0"
    )
    out, seen, depth = newest, newest.select(*cols), 0
    while max_depth is None or depth < max_depth:
        depth += 1
        found = (
            newest.join(step_edges, cols)
            .select(*keys, F.col("child").alias("node"))
            .distinct()
            .withColumn("depth", F.lit(depth))
        )
        newest = materialise(found.join(seen, cols, "left_anti"), f"reach-{depth}")
        if newest.isEmpty():
            break
        out = out.unionByName(newest)
        seen = out.select(*cols)
    return out


def reachable_by_doubling(
    edges: DataFrame, roots: DataFrame, keys: tuple[str, ...] = ()
) -> DataFrame:
    """The result of ``reachable`` without a bound, in about log2 of the depth rounds.

    Round k knows all nodes nearer than 2^k steps and the jumps of exactly 2^k steps.  Nodes plus
    one jump give the next nodes, two jumps in a row the next jumps.  A shortest way of up to twice
    the length is a shortest way followed by one jump, so depths are exact; a round that finds
    nothing new ends the search, cycles included.  Chains and forests have no more jumps than
    nodes; a dense graph of small depth is better served by ``reachable``.
    """
    cols = [*keys, "node"]
    jumps = materialise(
        edges.select(*keys, F.col("parent").alias("node"), F.col("child").alias("to")).distinct(), "jumps-0"
    )
    found = materialise(roots.select(*cols).distinct().withColumn("depth", F.lit(0)), "doubling-0")
    n, length = found.count(), 1
    while True:
        farther = found.join(jumps, cols).select(
            *keys, F.col("to").alias("node"), (F.col("depth") + length).alias("depth")
        )
        found = materialise(
            found.unionByName(farther).groupBy(*cols).agg(F.min("depth").alias("depth")), f"doubling-{length}"
        )
        now = found.count()
        if now == n:
            return found
        n, length = now, 2 * length
        onward = jumps.select(*keys, F.col("node").alias("to"), F.col("to").alias("_end"))
        jumps = materialise(
            jumps.join(onward, [*keys, "to"]).select(*cols, F.col("_end").alias("to")).distinct(), f"jumps-{length}"
        )


def lineage(
    spark: SparkSession,
    folder: str,
    entry_job: str,
    only_enabled: bool = False,
    max_depth: int | None = None,
) -> DataFrame:
    """(job_name, file, from_table, to_table, enabled) for all pipelines an entry job reaches."""
    entries = job_entries(spark, folder)
    nested = entries.where(F.endswith("child", F.lit(JOB_SUFFIX)))
    edges = nested.select(F.col("file").alias("parent"), "child")
    root = spark.createDataFrame([(entry_job,)], "node string")
    jobs = reachable(edges, root, max_depth=max_depth).select(F.col("node").alias("file"))
    steps = (
        entries.join(jobs, "file", "left_semi")
        .where(F.endswith("child", F.lit(STEP_SUFFIX)))
        .where(~F.endswith("entry_name", F.lit(SENTINEL)))
        .where(~F.endswith("child", F.lit(SENTINEL + STEP_SUFFIX)))
        .select(F.col("entry_name").alias("job_name"), F.col("child").alias("file"))
        .distinct()
    )
    found = hops(spark, folder)
    ends = terminal_hops(found)
    if only_enabled:
        ends = ends.where("enabled")
    return ends.join(steps, "file").select(
        "job_name", "file", "from_table", "to_table", "enabled"
    )


def missing_children(spark: SparkSession, folder: str) -> DataFrame:
    """(file, entry_name, child): entries whose child file is not in the folder."""
    entries = job_entries(spark, folder)
    present = (
        spark.read.format("binaryFile")
        .load(f"{folder.rstrip('/')}/*.k[tj][rb]")
        .select(file_name().alias("child"))
    )
    return entries.join(present, "child", "left_anti").select("file", "entry_name", "child")
