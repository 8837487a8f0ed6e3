"""Logs that grow: an index of what was read, so that a run reads and numbers new bytes only.

The index is a table with one row per block read: file, where the block starts and ends, how many
lines it has, how many stand before it, and the run that read it.  A run lists the files, compares their sizes with the
index and plans blocks over the bytes beyond it; nothing before them is opened again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..durable import materialise
from ..shipping import ship

BLOCK_BYTES = 64 << 20
_INDEX = "file string, block long, block_end long, lines_before long, lines long, run int"
_LINES = "file string, block long, block_end long, row long, value string"
_READ_AHEAD = 1 << 20


@dataclass
class Block:
    """Bytes ``start`` to ``end`` of a file; the lines that begin there belong to it."""

    file: str
    start: int
    end: int
    first: int  # where the file's new bytes begin: a line starts there


@dataclass
class _Task(InputPartition):
    blocks: list[Block]


class _BlockReader(DataSourceReader):
    def __init__(self, blocks: list[Block], task_bytes: int, batch_bytes: int) -> None:
        self.blocks, self.task_bytes, self.batch_bytes = blocks, task_bytes, batch_bytes

    def partitions(self) -> Sequence[InputPartition]:
        """Small blocks share a task."""
        tasks, size = [_Task([])], 0
        for block in self.blocks:
            if size + block.end - block.start > self.task_bytes and tasks[-1].blocks:
                tasks.append(_Task([]))
                size = 0
            tasks[-1].blocks.append(block)
            size += block.end - block.start
        return tasks

    def read(self, task: _Task) -> Iterator:
        for block in task.blocks:
            yield from self._lines(block)

    def _lines(self, block: Block) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(block.file)
        with store.open_input_file(path) as file:
            place = block.start
            if block.start > block.first:  # a line begins behind the first end of line from here on
                place = _line_end(file, block.start - 1)
            row = 0
            while place < block.end:
                stop = min(block.end, place + self.batch_bytes)
                stop = _line_end(file, stop - 1)
                data = file.read_at(stop - place, place)
                breaks = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10) + 1
                offsets = np.concatenate([[0], breaks]).astype(np.int32)
                lines = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
                lines = pc.ascii_rtrim(lines, characters="\r\n")
                n = len(lines)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(block.file, n), pa.repeat(block.start, n), pa.repeat(block.end, n),
                     pa.array(np.arange(row, row + n)), lines],
                    names=["file", "block", "block_end", "row", "value"],
                )
                place, row = stop, row + n


def _line_end(file, place: int) -> int:
    """The place behind the first end of line at or after ``place``."""
    while True:
        data = file.read_at(_READ_AHEAD, place)
        at = data.find(b"\n")
        if at >= 0:
            return place + at + 1
        if len(data) < _READ_AHEAD:
            return place + len(data)
        place += len(data)


class _Blocks(DataSource):
    """The lines of given blocks; the blocks are an option of the scan."""

    @classmethod
    def name(cls) -> str:
        return "tidewright_log_blocks"

    def schema(self) -> str:
        return _LINES

    def reader(self, schema) -> DataSourceReader:
        blocks = [Block(*b) for b in json.loads(self.options["blocks"])]
        return _BlockReader(blocks, int(self.options["task_bytes"]), int(self.options["batch_bytes"]))


def _sizes(spark: SparkSession, paths: str | Sequence[str]) -> dict[str, int]:
    """Size of every file that a path or pattern names, folders included."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    found: dict[str, int] = {}
    for text in [paths] if isinstance(paths, str) else paths:
        files = path(text).getFileSystem(conf)
        for status in files.globStatus(path(text)) or []:
            inside = files.listStatus(status.getPath()) if status.isDirectory() else [status]
            for f in inside:
                if f.isFile() and f.getPath().getName()[0] not in "._":
                    found[_uri(f.getPath().toUri().toString())] = f.getLen()
    return found


def _uri(text: str) -> str:
    """Local names with an empty host, as both Spark's file column and pyarrow write them."""
    scheme, _, path = text.partition(":")
    return f"file:///{path.lstrip('/')}" if scheme == "file" else text


def _whole_lines(file: str, start: int, size: int) -> int:
    """Where the last complete line of a file ends: bytes behind it are still being written."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(file)
    with store.open_input_file(path) as stream:
        end = size
        while end > start:
            begin = max(start, end - _READ_AHEAD)
            at = stream.read_at(end - begin, begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return start


class LogIndex:
    """What was read of a set of growing logs, in a table at ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    def blocks(self) -> DataFrame:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not files.exists(folder):
            return self.spark.createDataFrame([], _INDEX)
        return self.spark.read.schema(_INDEX).parquet(self.path)

    def next_run(self) -> int:
        """Number of the run that has not been committed yet."""
        last = self.blocks().agg(F.max("run").alias("run")).first()["run"]
        return 0 if last is None else last + 1

    def known(self) -> dict[str, tuple[int, int]]:
        """For each file how many bytes and lines were read; as long as the list of files."""
        ends = self.blocks().groupBy("file").agg(
            F.max("block_end").alias("size"), F.sum("lines").alias("lines")
        )
        return {r["file"]: (r["size"], r["lines"]) for r in ends.collect()}

    def take(
        self, paths: str | Sequence[str], block_bytes: int = BLOCK_BYTES, batch_bytes: int = 8 << 20
    ) -> Taken:
        """Lines (file, line_no, value) that the logs have gained since the index was written.

        Every complete line counts, blank ones too; a last line without its end is left for the
        next run.  A file that is shorter than the index says was replaced, which is an error.
        The new lines are written once; ``Taken.commit`` adds them to the index, and until then
        the same bytes are taken again.  Files are opened by pyarrow, so their store must be one it
        knows.
        """
        ship(self.spark)
        known, blocks = self.known(), []
        for file, size in sorted(_sizes(self.spark, paths).items()):
            start = known.get(file, (0, 0))[0]
            if size < start:
                raise ValueError(f"{file} is shorter than what was read of it")
            end = _whole_lines(file, start, size) if size > start else start
            blocks += [(file, a, min(a + block_bytes, end), start) for a in range(start, end, block_bytes)]
        self.spark.dataSource.register(_Blocks)
        read = (
            self.spark.read.format(_Blocks.name()).option("blocks", json.dumps(blocks))
            .option("task_bytes", str(block_bytes)).option("batch_bytes", str(batch_bytes)).load()
            if blocks
            else self.spark.createDataFrame([], _LINES)
        )
        return Taken(self, self.next_run(), blocks, known, materialise(read, "appended-lines"))


@dataclass(frozen=True)
class Taken:
    """New lines of one run; ``planned`` are the blocks that were scanned."""

    index: LogIndex
    run: int
    planned: list[tuple[str, int, int, int]]
    known: dict[str, tuple[int, int]]
    written: DataFrame

    def _numbered_blocks(self) -> DataFrame:
        spark = self.index.spark
        every = spark.createDataFrame(
            [(f, a, b, self.known.get(f, (0, 0))[1]) for f, a, b, _ in self.planned],
            "file string, block long, block_end long, known long",
        )
        counts = self.written.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"))
        before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        lines = F.coalesce("n", F.lit(0).cast("long"))
        return every.join(counts, ["file", "block"], "left").select(
            "file", "block", "block_end",
            (F.col("known") + F.coalesce(F.sum(lines).over(before), F.lit(0))).alias("lines_before"),
            lines.alias("lines"),
        )

    @property
    def lines(self) -> DataFrame:
        offsets = self._numbered_blocks().select("file", "block", "lines_before")
        return self.written.join(offsets, ["file", "block"]).select(
            "file", (F.col("row") + F.col("lines_before") + 1).alias("line_no"), "value"
        )

    def commit(self) -> None:
        """Say that the new lines were stored.  A run without new lines leaves no mark."""
        if self.planned:
            self._numbered_blocks().coalesce(1).write.mode("overwrite").parquet(f"{self.index.path}/run={self.run}")
