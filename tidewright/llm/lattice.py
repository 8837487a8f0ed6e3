"""Near-duplicate vectors by lattice hashing.

In each table a random projection maps a direction to BLOCKS times eight dimensions, and each
eight go to the nearest point of the E8 lattice: the points name a cell.  Every vector lives in its
own cell of each table and also probes the neighbouring cells that lie nearest, so a pair meets if
one of the two probes the other's cell in some table.  Pairs that meet are verified by cosine in
double precision.  With the settings here a pair at cosine 0.9 meets with a probability above 0.97,
closer pairs practically always.

Equal vectors are one class; only one of them goes through the tables.  Cells are compared in
blocks, so a full cell is dealt over many tasks, and what leaves a block are sums of links per
vector and the edges of a spanning forest, never the pairs.  A pair that meets in several cells is
counted in the first of them, which both vectors know from their cells.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import materialise
from .graph import components
from .minhash import Forest, lists, mixed
from .support import small_batches

TABLES, BLOCKS, PROBES, SCALE = 12, 3, 16, 0.8
#: Nearest points looked at in each block of eight dimensions when the probes are put together.
_NEAR = 8
BLOCK = 256


@functools.lru_cache(maxsize=1)
def neighbours() -> np.ndarray:
    """The 240 shortest lattice vectors."""
    whole = [
        [s * (k == i) + t * (k == j) for k in range(8)]
        for i, j in itertools.combinations(range(8), 2)
        for s in (1, -1)
        for t in (1, -1)
    ]
    half = [v for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array([*whole, *half], dtype=np.float64)


def nearest_point(y: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row: the better of D8 and D8 shifted by a half."""

    def even(y: np.ndarray) -> np.ndarray:
        r = np.rint(y)
        off = y - r
        odd = np.flatnonzero(r.sum(axis=1).astype(np.int64) % 2)
        worst = np.abs(off[odd]).argmax(axis=1)
        r[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
        return r

    a, b = even(y), even(y - 0.5) + 0.5
    return np.where(((y - a) ** 2).sum(axis=1, keepdims=True) <= ((y - b) ** 2).sum(axis=1, keepdims=True), a, b)


@functools.lru_cache(maxsize=8)
def _projection(dim: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng([seed, dim])
    return rng.normal(size=(dim, TABLES * BLOCKS * 8)) / np.sqrt(8) / SCALE


def cells(unit: np.ndarray, seed: int = 1) -> np.ndarray:
    """Names of the PROBES nearest cells per table for unit vectors, the own cell first."""
    n, dim = unit.shape
    y = (unit @ _projection(dim, seed)).reshape(-1, 8)
    home = nearest_point(y)
    gain = (y - home) @ neighbours().T
    near = np.argpartition(-gain, _NEAR - 2, axis=1)[:, : _NEAR - 1]
    extra = 2 - 2 * np.take_along_axis(gain, near, axis=1)
    extra = np.concatenate([np.zeros((len(y), 1)), extra], axis=1).reshape(n * TABLES, BLOCKS, _NEAR)
    points = np.concatenate([home[:, None, :], home[:, None, :] + neighbours()[near]], axis=1)

    names = np.full(points.shape[:2], np.uint64(dim))
    for k in range(8):
        names = mixed(names * np.uint64(0x9E3779B97F4A7C15) + (2 * points[:, :, k]).astype(np.int64).view(np.uint64))
    names = names.reshape(n * TABLES, BLOCKS, _NEAR)

    total, joined = extra[:, 0], names[:, 0]
    for b in range(1, BLOCKS):
        total = (total[:, :, None] + extra[:, b][:, None, :]).reshape(len(total), -1)
        joined = mixed(joined[:, :, None] * np.uint64(3) + names[:, b][:, None, :]).reshape(len(joined), -1)
    total[:, 0] = -1.0  # the own cell
    first = np.argpartition(total, PROBES - 1, axis=1)[:, :PROBES]
    first = np.take_along_axis(first, np.take_along_axis(total, first, axis=1).argsort(axis=1, kind="stable"), axis=1)
    out = np.take_along_axis(joined, first, axis=1).reshape(n, TABLES, PROBES)
    return mixed(out + (np.arange(TABLES, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))[None, :, None]).view(np.int64)


def usable(vector: list | None) -> np.ndarray | None:
    """Direction of a vector in double precision; None if it has none."""
    if not vector or any(x is None for x in vector):
        return None
    v = np.array(vector, dtype=np.float64)
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    v = v / top
    return v / np.sqrt((v * v).sum())


def _units(vectors: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            found = [usable(v) if i is not None else None for i, v in zip(ids, batch.column(1).to_pylist(), strict=True)]
            digests = [None if v is None else hashlib.blake2b(v.tobytes(), digest_size=20).digest() for v in found]
            offsets = np.concatenate([[0], np.cumsum([0 if v is None else len(v) for v in found])]).astype(np.int32)
            flat = np.concatenate([np.empty(0), *(v for v in found if v is not None)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["vec_id", "digest", "unit"],
            )

    return vectors.mapInArrow(run, "vec_id long, digest binary, unit array<double>")


def _rows_of(column: pa.ListArray) -> list[np.ndarray]:
    values, places = column.values.to_numpy(), column.offsets.to_numpy()
    return [values[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]


def _with_cells(classes: DataFrame, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _rows_of(batch.column(2))
            names = [np.empty(0, dtype=np.int64)] * len(units)
            for dim in {len(u) for u in units}:
                rows = [i for i, u in enumerate(units) if len(u) == dim]
                for i, c in zip(rows, cells(np.stack([units[i] for i in rows]), seed), strict=True):
                    names[i] = c.ravel()
            yield pa.RecordBatch.from_arrays([*batch.columns, lists(names)], names=["rep", "copies", "unit", "cells"])

    return classes.mapInArrow(run, "rep long, copies long, unit array<double>, cells array<long>")


def block_links(
    key: int, rep: np.ndarray, copies: np.ndarray, asks: np.ndarray, unit: np.ndarray, names: np.ndarray, limit: float
) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Links per vector, and tree edges, of one block: those that live in the cell against all in it."""
    a, b = np.flatnonzero(asks), np.flatnonzero(~asks)
    if not len(a) or not len(b):
        return [], []
    names = names.reshape(len(rep), TABLES, PROBES)
    x, y = np.nonzero(unit[a] @ unit[b].T >= limit - 1e-9)
    x, y = a[x], b[y]
    exact = np.einsum("ij,ij->i", unit[x], unit[y]) >= limit
    lives_y = (names[y][:, :, 0] == key).any(axis=1)
    once = exact & (rep[x] != rep[y]) & (~lives_y | (rep[x] < rep[y]))
    x, y = x[once], y[once]
    if not len(x):
        return [], []
    low, high = np.where(rep[x] < rep[y], x, y), np.where(rep[x] < rep[y], y, x)
    at_low = (names[high] == names[low][:, :, :1]).any(axis=2)
    at_high = (names[low] == names[high][:, :, :1]).any(axis=2)
    order = np.stack([at_low, at_high], axis=2).reshape(len(x), -1)
    cell = np.stack([names[low][:, :, 0], names[high][:, :, 0]], axis=2).reshape(len(x), -1)
    here = cell[np.arange(len(x)), order.argmax(axis=1)] == key
    x, y = x[here], y[here]
    sums, forest, edges = {}, Forest(), []
    for i, j in zip(x.tolist(), y.tolist(), strict=True):
        p, q = int(rep[i]), int(rep[j])
        sums[p] = sums.get(p, 0) + int(copies[j])
        sums[q] = sums.get(q, 0) + int(copies[i])
        if forest.join(p, q):
            edges.append((p, q))
    return list(sums.items()), edges


def _blocks_linked(rows: DataFrame, limit: float) -> DataFrame:
    """``kind`` (links or edge), ``a`` and ``n`` of all blocks ``key``, ``i``, ``j``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        name = None

        def close(out: list[tuple[bool, int, int]]) -> None:
            if held:
                rep, copies, asks, unit, own = zip(*held, strict=True)
                sums, edges = block_links(
                    name[0], np.array(rep), np.array(copies), np.array(asks), np.stack(unit), np.stack(own), limit
                )
                out += [(False, *s) for s in sums] + [(True, *e) for e in edges]

        def packed(out: list[tuple[bool, int, int]]) -> pa.RecordBatch:
            kinds = (pa.bool_(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], names=["edge", "a", "n"]
            )

        for batch in batches:
            out: list[tuple[bool, int, int]] = []
            key, i, j, rep, copies, asks = (batch.column(k).to_pylist() for k in range(6))
            units, own = _rows_of(batch.column(6)), _rows_of(batch.column(7))
            for r in range(batch.num_rows):
                if (key[r], i[r], j[r]) != name:
                    close(out)
                    held, name = [], (key[r], i[r], j[r])
                held.append((rep[r], copies[r], asks[r], units[r].copy(), own[r].copy()))
            yield packed(out)
        out = []
        close(out)
        yield packed(out)

    return rows.mapInArrow(run, "edge boolean, a long, n long")


def near_vectors(
    vectors: DataFrame, limit: float = 0.9, seed: int = 1, id_col: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Links are pairs found with cosine >= ``limit`` (none below it).  Vectors that are null, empty,
    zero or hold a null or non-finite component, and rows without id, link with nothing and stay.
    Vectors of different lengths are never linked.  Equal vectors link with each other.  Rows that
    repeat an id count as further copies.
    """
    small_batches(vectors.sparkSession, 1024)
    read = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    units = materialise(_units(read), "unit-vectors")
    classes = (
        units.where(F.col("digest").isNotNull())
        .groupBy("digest")
        .agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min_by("unit", "vec_id").alias("unit"))
    )
    known = materialise(_with_cells(classes.select("rep", "copies", "unit"), seed), "cells")

    visits = known.select("rep", F.posexplode("cells").alias("at", "key")).select(
        "rep", "key", (F.col("at") % PROBES == 0).alias("lives")
    )
    full = (
        visits.groupBy("key")
        .agg(F.sum(F.col("lives").cast("long")).alias("h"), F.count(F.lit(1)).alias("m"))
        .where("h > 0 and m > 1")
        .select("key", F.ceil(F.col("h") / BLOCK).alias("asking"), F.ceil(F.col("m") / BLOCK).alias("asked"))
    )
    dealt = materialise(visits.join(full, "key").withColumn("_h", F.xxhash64("rep")), "visits")
    zero = F.lit(0).cast("long")
    as_member = dealt.select(
        "key", "rep", F.lit(False).alias("asks"), F.explode(F.sequence(zero, F.col("asking") - 1)).alias("i"),
        F.pmod("_h", "asked").alias("j"),
    )
    as_asker = dealt.where("lives").select(
        "key", "rep", F.lit(True).alias("asks"), F.pmod("_h", "asking").alias("i"),
        F.explode(F.sequence(zero, F.col("asked") - 1)).alias("j"),
    )
    blocks = (
        as_member.unionByName(as_asker)
        .join(known, "rep")
        .select("key", "i", "j", "rep", "copies", "asks", "unit", "cells")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
    )
    found = materialise(_blocks_linked(blocks, limit), "vector-links")
    joined = components(found.where("edge").select("a", F.col("n").alias("b")), "vectors")
    sums = found.where(~F.col("edge")).groupBy("a").agg(F.sum("n").alias("_others"))
    named = (
        classes.select("digest", "rep", "copies")
        .join(sums.withColumnRenamed("a", "rep"), "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "digest",
            (F.coalesce("_others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    return (
        units.select("vec_id", "digest")
        .join(named, "digest", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
