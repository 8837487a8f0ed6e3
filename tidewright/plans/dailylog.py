"""A store of log events that takes in only what the logs have gained."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.carry import carry_forward, last_known
from ..operators.loglines import drop_blank, parse_events, started_pipeline
from ..sources.appended import BLOCK_BYTES, LogIndex

_EVENTS = (
    "file string, line_no long, ts timestamp_ntz, step string, copy int, detail string, raw string,"
    " pipeline string, run int"
)


@dataclass(frozen=True)
class LogStore:
    """Parsed events under ``folder``, with the pipeline that was running at each line.

    A run writes its events and the pipeline each file ends with under its own number, then commits
    the index.  Until that commit nobody reads what it wrote, and a run that failed is made again
    under the same number.
    """

    spark: SparkSession
    folder: str

    @property
    def index(self) -> LogIndex:
        return LogIndex(self.spark, f"{self.folder}/index")

    def _runs(self, name: str, schema: str) -> DataFrame:
        runs = self.index.next_run()
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/{name}").parquet(
            *[f"{self.folder}/{name}/run={n}" for n in range(runs)]
        )

    @property
    def events(self) -> DataFrame:
        """All events of committed runs, each with the ``run`` that took it in."""
        return self._runs("events", _EVENTS)

    def _running(self) -> DataFrame:
        """The pipeline that was running at the end of each file."""
        left = self._runs("running", "file string, pipeline string, run int")
        return left.groupBy("file").agg(F.max_by("pipeline", "run").alias("pipeline"))

    def take(self, paths: str | Sequence[str], block_bytes: int = BLOCK_BYTES) -> list[tuple]:
        """Take in the new lines of the logs; returns the blocks that were read."""
        taken = self.index.take(paths, block_bytes)
        if not taken.planned:
            return []
        new = parse_events(drop_blank(taken.lines))
        new = carry_forward(new, started_pipeline(F.col("detail")), "pipeline", before=self._running())
        target = f"{self.folder}/events/run={taken.run}"
        new.select("file", "line_no", "ts", "step", "copy", "detail", "raw", "pipeline").write.mode(
            "overwrite"
        ).parquet(target)
        stored = self.spark.read.parquet(target)
        last_known(stored, "pipeline").coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/running/run={taken.run}"
        )
        taken.commit()
        return taken.planned
