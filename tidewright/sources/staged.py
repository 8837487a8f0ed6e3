"""Loads that are published whole or not at all, behind an audit of their row counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.audit import counted

_AUDIT = (
    "name string, version int, rows_read long, rows_rejected long, rows_written long,"
    " published boolean, at timestamp_ntz"
)


class Refused(Exception):
    """An audit did not let a load through; the published table is what it was."""


@dataclass(frozen=True)
class Counts:
    read: int
    rejected: int
    written: int


def all_accounted_for(counts: Counts) -> bool:
    """Every row that was read was either rejected or is in the written files."""
    return counts.read == counts.rejected + counts.written


@dataclass(frozen=True)
class StagedTable:
    """Versions of one table under ``folder``; the highest published one is the table.

    A load is written to a staging folder, audited, and becomes visible by the one rename that
    gives the folder its version.  Readers that began before keep the version they read.  Every
    attempt leaves a row in the audit table.
    """

    spark: SparkSession
    folder: str
    name: str

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path, path(self.folder).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def versions(self) -> list[int]:
        path, files = self._files()
        found = files.globStatus(path(f"{self.folder}/{self.name}/v=*")) or []
        return sorted(int(f.getPath().getName()[2:]) for f in found)

    def read(self) -> DataFrame:
        """The published table."""
        return self.spark.read.parquet(f"{self.folder}/{self.name}/v={self.versions()[-1]}")

    def audits(self) -> DataFrame:
        return self.spark.read.schema(_AUDIT).parquet(f"{self.folder}/{self.name}-audit")

    def load(
        self,
        source: DataFrame,
        accept: Column,
        at: dt.datetime,
        gate: Callable[[Counts], bool] = all_accounted_for,
    ) -> Counts:
        """Load the rows of ``source`` for which ``accept`` is true; a null counts as rejected.

        Rows read and rejected are counted by observations of the writing job itself, rows written
        by the footers of what was written.  If ``gate`` says no, ``Refused`` is raised and the
        staged files are removed.
        """
        version = (self.versions() or [-1])[-1] + 1
        staging = f"{self.folder}/{self.name}/staging-{version}"
        ok = F.coalesce(accept, F.lit(False))
        marked, seen = counted(source.withColumn("_ok", ok), f"{self.name}-read-{version}")
        taken, kept = counted(marked.where("_ok").drop("_ok"), f"{self.name}-kept-{version}")
        taken.write.mode("overwrite").parquet(staging)
        written = self.spark.read.parquet(staging).count()
        counts = Counts(seen.get["rows"], seen.get["rows"] - kept.get["rows"], written)
        published = gate(counts)
        path, files = self._files()
        if published:
            files.rename(path(staging), path(f"{self.folder}/{self.name}/v={version}"))
        else:
            files.delete(path(staging), True)
        row = (self.name, version, counts.read, counts.rejected, counts.written, published, at)
        self.spark.createDataFrame([row], _AUDIT).coalesce(1).write.mode("append").parquet(f"{self.folder}/{self.name}-audit")
        if not published:
            raise Refused(f"{self.name}: {counts}")
        return counts
