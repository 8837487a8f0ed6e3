"""Whitening of embeddings with every distinct vector handled once.

Entries become whole numbers, so equal vectors are found exactly.  Each distinct vector is one row
with its multiplicity, and the fit weighs it by one or by that count.  Tasks centre their rows and
multiply them into one partial covariance each; Spark sums the cells.  Only the finished matrix,
bounded by the square of a vector's length, reaches the driver for its eigenvectors.  Distinct
vectors are whitened once and joined back to the rows, where hot vectors are dealt over many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..durable import materialise
from ..operators.skew import split_join
from .support import ship

SCALE = 64.0
SHIFT = 1_000_000
#: Entries whose whole number lies farther out than this are held at it.
FARTHEST = float(1 << 62)
#: Directions with less than this part of the largest variance count as flat.
FLAT = 1e-11
_SAFE = 1 << 62

_RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


class Space(NamedTuple):
    """What is fitted for vectors of one length."""

    n: int
    sums: list[int]
    axes: np.ndarray  # one row per component
    values: np.ndarray
    trace: float

    @property
    def live(self) -> np.ndarray:
        return self.values > FLAT * max(self.values.max(initial=0.0), 0.0)


@dataclass(frozen=True)
class Rows:
    """Whole-number vectors of one length."""

    dim: int
    x: np.ndarray
    weight: np.ndarray
    at: np.ndarray

    def scaled(self, n: int, sums: list[int]) -> np.ndarray:
        """``n * x - S``, exact; Python's integers where 64 bits might not hold it."""
        most = int(np.abs(self.x).max(initial=0))
        if n * most < _SAFE and max(map(abs, sums), default=0) < _SAFE:
            return n * self.x - np.array(sums, dtype=np.int64)
        return self.x.astype(object) * n - np.array(sums, dtype=object)

    def centred(self, n: int, sums: list[int]) -> np.ndarray:
        return (self.scaled(n, sums) / n).astype(np.float64)


def _quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``dim``, a digest and the whole numbers as bytes, of the rows that have a usable vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known = batch.filter(batch.column(1).is_valid())
            lists = known.column(1)
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            odd = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            fine = np.flatnonzero(odd[ends] == odd[ends - sizes])
            with np.errstate(all="ignore"):
                whole = np.clip(np.floor(flat * SCALE), -FARTHEST, FARTHEST)
            whole = np.where(np.isfinite(whole), whole, 0.0).astype(np.int64) + SHIFT
            bodies = [whole[ends[i] - sizes[i] : ends[i]].astype("<i8").tobytes() for i in fine]
            keys = [hashlib.blake2b(b, digest_size=20).digest() for b in bodies]
            yield pa.RecordBatch.from_arrays(
                [known.column(0).take(pa.array(fine)), pa.array(sizes[fine].astype(np.int32)), pa.array(keys, pa.binary()),
                 pa.array(bodies, pa.binary())],
                names=["vec_id", "dim", "key", "x"],
            )

    return vectors.mapInArrow(run, "vec_id long, dim int, key binary, x binary")


def _by_length(batch: pa.RecordBatch) -> Iterator[Rows]:
    dims = batch.column("dim").to_numpy()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        body = b"".join(batch.column("x").take(pa.array(at)).to_pylist())
        x = np.frombuffer(body, dtype="<i8").reshape(len(at), dim)
        yield Rows(dim, x, batch.column("weight").to_numpy()[at], at)


def _summed(distinct: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Weight and exact sum of every dimension, by vector length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list[int]] = {}
        for batch in batches:
            for rows in _by_length(batch):
                most = int(np.abs(rows.x).max(initial=0)) * int(rows.weight.sum())
                kind = np.int64 if most < _SAFE else object
                parts = (rows.x.astype(kind) * rows.weight.astype(kind)[:, None]).sum(axis=0).tolist()
                old = totals.get(rows.dim, [0] * (rows.dim + 1))
                totals[rows.dim] = [a + int(b) for a, b in zip(old, [*parts, rows.weight.sum()], strict=True)]
        for dim, sums in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * len(sums), pa.int32()), pa.array(range(len(sums)), pa.int32()), pa.array(map(str, sums), pa.string())],
                names=["dim", "i", "part"],
            )

    cells = distinct.mapInArrow(run, "dim int, i int, part string")
    total = cells.groupBy("dim", "i").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total"))
    sums: dict[int, dict[int, int]] = {}
    for r in total.collect():
        sums.setdefault(r["dim"], {})[r["i"]] = int(r["total"])
    return {dim: (x[dim], [x[i] for i in range(dim)]) for dim, x in sums.items()}


def _products(frame: DataFrame, centred: Callable[[pa.RecordBatch], Iterator[tuple[int, np.ndarray, np.ndarray]]]) -> dict[int, np.ndarray]:
    """Weighted sums of products of centred rows, by vector length; ``centred`` gives length, rows and weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, rows, weight in centred(batch):
                product = (rows * weight[:, None]).T @ rows
                parts[dim] = parts[dim] + product if dim in parts else product
        for dim, part in parts.items():
            i, j = np.triu_indices(len(part))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), dim, dtype=np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(part[i, j])],
                names=["dim", "i", "j", "part"],
            )

    cells = frame.mapInArrow(run, "dim int, i int, j int, part double")
    table = cells.groupBy("dim", "i", "j").agg(F.sum("part").alias("total")).toArrow()
    dims, i, j, total = (table.column(k).to_numpy() for k in range(4))
    out = {}
    for dim in np.unique(dims).tolist():
        at = dims == dim
        size = int(j[at].max()) + 1
        full = np.zeros((size, size))
        full[i[at], j[at]] = full[j[at], i[at]] = total[at]
        out[dim] = full
    return out


def fit(distinct: DataFrame, components: int) -> dict[int, Space]:
    """Eigenvectors of the covariance, by vector length; the larger of an axis' entries is positive."""
    known = {dim: x for dim, x in _summed(distinct).items() if dim}

    def centred(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        for rows in _by_length(batch):
            if rows.dim:
                yield rows.dim, rows.centred(*known[rows.dim]), rows.weight.astype(np.float64)

    spaces = {}
    for dim, product in (_products(distinct, centred) if known else {}).items():
        n, sums = known[dim]
        values, vectors = np.linalg.eigh(product / n)
        axes = vectors[:, ::-1][:, :components].T
        signs = np.sign(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)])
        spaces[dim] = Space(n, sums, axes * signs[:, None], values[::-1][:components], float(np.trace(product) / n))
    return spaces


def _deviations(scaled: np.ndarray) -> list[int | None]:
    """Sums of squares, exact; null beyond 64 bits."""
    if scaled.dtype != object and (scaled.astype(np.float64) ** 2).sum(axis=1).max(initial=0.0) < _SAFE:
        return (scaled * scaled).sum(axis=1).tolist()
    sums = [sum(int(v) * int(v) for v in row) for row in scaled]
    return [s if s < 1 << 63 else None for s in sums]


def _whitened(distinct: DataFrame, spaces: dict[int, Space]) -> DataFrame:
    """``key``, ``dim``, ``weight``, ``deviation`` and ``z`` (null where the direction is flat)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in _by_length(batch):
                if not rows.dim:
                    continue
                space = spaces[rows.dim]
                scaled = rows.scaled(space.n, space.sums)
                with np.errstate(all="ignore"):
                    z = (scaled / space.n).astype(np.float64) @ space.axes.T / np.sqrt(space.values)
                flat = np.broadcast_to(~space.live, z.shape).ravel()
                ends = np.arange(len(z) + 1, dtype=np.int32) * z.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").take(pa.array(rows.at)), pa.array(np.full(len(z), rows.dim, dtype=np.int32)),
                     pa.array(rows.weight), pa.array(_deviations(scaled), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(z.ravel(), mask=flat))],
                    names=["key", "dim", "weight", "deviation", "z"],
                )

    return distinct.mapInArrow(run, "key binary, dim int, weight long, deviation long, z array<double>")


def identity_errors(whitened: DataFrame, spaces: dict[int, Space]) -> dict[int, float]:
    """How far the covariance of what was whitened is from the identity, over directions that are not flat."""
    each = whitened.select("dim", "weight", F.posexplode("z").alias("i", "v"))
    means: dict[int, np.ndarray] = {dim: np.zeros(len(s.values)) for dim, s in spaces.items()}
    for r in each.groupBy("dim", "i").agg((F.sum(F.col("v") * F.col("weight")) / F.sum("weight")).alias("m")).collect():
        means[r["dim"]][r["i"]] = r["m"] or 0.0

    def centred(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        dims, weight = batch.column("dim").to_numpy(), batch.column("weight").to_numpy().astype(np.float64)
        for dim in np.unique(dims).tolist():
            at = np.flatnonzero(dims == dim)
            z = batch.column("z").take(pa.array(at)).flatten().fill_null(0.0).to_numpy(zero_copy_only=False)
            yield dim, z.reshape(len(at), -1) - means[dim], weight[at]

    errors = {}
    for dim, product in _products(whitened, centred).items():
        live = np.flatnonzero(spaces[dim].live)
        gap = product[np.ix_(live, live)] / spaces[dim].n - np.eye(len(live))
        errors[dim] = float(np.abs(gap).max(initial=0.0))
    return errors


def _by_dim(values: dict[int, Column]) -> Column:
    """One value per vector length, as an expression."""
    chosen = F.lit(None)
    for dim, value in values.items():
        chosen = F.when(F.col("dim") == dim, value).otherwise(chosen)
    return chosen


def whiten(
    vectors: DataFrame,
    components: int = 16,
    weigh_by: str = "one",
    id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """One row per usable vector and component: ``vec_id``, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``.

    An entry c becomes floor(64 * c) + 1000000.  The fit list is each distinct vector, weighed by
    one, or by how many rows have it (``weigh_by="count"``); ``n`` is its total weight.
    Components are eigenvectors of its covariance by falling eigenvalue, ``deviation`` is the exact
    sum of (n * x - S) squared.

    Rows with a null vector, or with null or non-finite entries, are left out.  A vector without
    entries has no components and so no rows.  Vectors of each length are a space of their own.
    Repeated rows and repeated or null ids each get their own rows.  In a direction without
    variance (fewer distinct vectors than components, say) ``whitened`` is null and
    ``identity_error`` leaves it out; ``explained`` is null where nothing varies.  ``deviation`` is
    null beyond 64 bits, entries are held at +-2^62.  Only the id and the vector are read, so other
    columns may have any name.  An empty table gives no rows.

    The driver gets the sums and the upper half of the covariance matrix, which do not grow with
    the rows.
    """
    if weigh_by not in ("one", "count"):
        raise ValueError("weigh_by is one or count")
    spark = vectors.sparkSession
    ship(spark)
    read = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    rows = materialise(_quantised(read), "quantised")
    weight = F.count(F.lit(1)) if weigh_by == "count" else F.first(F.lit(1).cast("long"))
    distinct = materialise(rows.groupBy("dim", "key", "x").agg(weight.alias("weight")), "distinct-vectors")
    spaces = fit(distinct, components)
    if not spaces:
        return spark.createDataFrame([], _RESULT)
    whitened = materialise(_whitened(distinct, spaces), "whitened")
    errors = identity_errors(whitened, spaces)

    explained = {
        dim: F.array(*[F.lit(float(v / s.trace) if s.trace > 0 else None).cast("double") for v in s.values]) for dim, s in spaces.items()
    }
    joined = split_join(rows.select("vec_id", "key"), whitened.drop("weight"), ["key"])
    each = joined.select("vec_id", "dim", "deviation", F.posexplode("z").alias("_at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("_at") + 1).cast("int").alias("component"),
        _by_dim({dim: F.lit(s.n).cast("long") for dim, s in spaces.items()}).alias("n"),
        "deviation",
        "whitened",
        F.get(_by_dim(explained), F.col("_at")).alias("explained"),
        _by_dim({dim: F.lit(errors[dim]) for dim in spaces}).alias("identity_error"),
    )
