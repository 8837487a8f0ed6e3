"""Near duplicates by fast similarity sketches, banding and exact verification.

A sketch has t coordinates.  In round i every shingle is hashed into one coordinate with a value
that starts with i, and coordinates keep their least value; rounds go on until all are filled, one
or two for long texts.  After t rounds, round t+j serves coordinate j alone, so 2t rounds always
fill the sketch.  Two sketches agree in a coordinate with the probability of the sets' similarity,
and the number of agreements is at least as concentrated as for t independent minima.

Texts with equal shingle sets are one class, and only one document of each goes on.  Bands of
coordinates put documents into buckets.  The most central member of a bucket, which shares the
most buckets with others, is its hub, and all members are verified against it on full sets.  What
is then not connected with the hub is verified against all members of the hub in blocks, except
where both sides are already connected.  So every pair that shares a bucket is either connected or
verified, without writing the pairs of a bucket.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..durable import materialise
from ..operators.skew import split_join
from .graph import components
from .support import small_batches, text_of
from .tokens import release

ROWS = 5
MISS = 1e-8
BLOCK = 128
_TOP = np.uint64(2**64 - 1)


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands with which a pair of just this similarity shares no bucket with probability ``miss``."""
    return math.ceil(math.log(miss) / math.log(1 - (percent / 100) ** rows))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _salts(n: int, start: int) -> np.ndarray:
    return mixed(np.arange(start + 1, start + n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of a string column, A-Z lower-cased, and where each text's begin.

    Distinct words of the column are hashed once.
    """
    import xxhash

    lowered = pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null("")))
    split = pc.ascii_split_whitespace(lowered)
    words = split.flatten().dictionary_encode()
    names = words.dictionary.view(pa.binary()).to_pylist()
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, names), dtype=np.uint64, count=len(names))
    # A text without words is split into one empty word.
    sizes = np.where(pc.binary_length(lowered).to_numpy() == 0, 0, np.diff(split.offsets.to_numpy()))
    filled = words.indices.to_numpy()
    empty = names.index(b"") if b"" in names else -1
    return hashed[filled[filled != empty]], np.concatenate([[0], np.cumsum(sizes)])


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles of ``width`` words, A-Z lower-cased.

    A text with fewer words has its whole sequence as one shingle, a text without words none.
    """
    hashes, places = _word_hashes(texts)
    salts = _salts(width, 0) | np.uint64(1)
    parts = [mixed(hashes + salt) * salt for salt in salts]
    rolled = np.zeros(max(0, len(hashes) - width + 1), dtype=np.uint64)
    for j, part in enumerate(parts):
        rolled += part[j : j + len(rolled)]
    rolled = mixed(rolled)
    out = []
    for a, b in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            short = np.array([parts[k][a + k] for k in range(b - a)], dtype=np.uint64)
            out.append(mixed(np.array([short.sum(dtype=np.uint64) + np.uint64(b - a)], dtype=np.uint64)))
        else:
            out.append(hashes[:0])
    return out


def sketch(shingles: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` coordinates of a set that is not empty; see the module text."""
    best = np.full(size, _TOP, dtype=np.uint64)
    salts, low, half = _salts(2 * size, 1000), np.uint64(0xFFFFFFFF), np.uint64(32)
    at_once = max(1, min(size, 4 * size // len(shingles)))
    for start in range(0, size, at_once):
        rounds = np.arange(start, min(size, start + at_once), dtype=np.uint64)
        hashed = mixed(shingles[None, :] ^ salts[start : start + len(rounds), None])
        bins = ((hashed >> half) * np.uint64(size)) >> half
        values = (rounds[:, None] << half) | (hashed & low)
        np.minimum.at(best, bins.ravel().astype(np.int64), values.ravel())
        if not (best == _TOP).any():
            return best
    for j in np.flatnonzero(best == _TOP):
        best[j] = (np.uint64(size + j) << half) | (mixed(shingles ^ salts[size + j]) & low).min()
    return best


def band_keys(coordinates: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit bucket name per band of ``rows`` coordinates."""
    bands = coordinates.reshape(-1, rows)
    keys = _salts(len(bands), 9000)
    for j in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + bands[:, j])
    return keys.view(np.int64)


def lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    flat = np.concatenate([np.empty(0, dtype=np.int64), *(p.view(np.int64) for p in parts)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _sketched(docs: DataFrame, width: int, percent: int) -> DataFrame:
    size = bands_for(percent) * ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1), width)
            digests = [hashlib.blake2b(s.tobytes(), digest_size=20).digest() if len(s) else None for s in sets]
            keys = [band_keys(sketch(s, size)) if len(s) else np.empty(0, dtype=np.int64) for s in sets]
            counts = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), counts, pa.array(digests, pa.binary()), lists(keys)], names=["doc_id", "n", "digest", "keys"]
            )
        release()

    return docs.mapInArrow(run, "doc_id long, n long, digest binary, keys array<long>")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(sets)], names=["doc_id", "shingles"])
        release()

    return docs.mapInArrow(run, "doc_id long, shingles array<long>")


class Forest:
    """Union-find over the labels of one block."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _block_links(labels: np.ndarray, asks: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Tree edges between labels of one block: askers against all members with another label."""
    members = np.flatnonzero(~asks)
    if not len(members):
        return []
    flat = np.concatenate([sets[i] for i in members])
    sizes = np.array([len(sets[i]) for i in members])
    names, place = np.unique(flat, return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    mark, forest, found = np.zeros(len(names), dtype=np.int64), Forest(), []
    for i in np.flatnonzero(asks):
        at = np.minimum(np.searchsorted(names, sets[i]), len(names) - 1)
        at = at[names[at] == sets[i]]
        mark[at] = 1
        common = np.add.reduceat(mark[place], starts)
        mark[at] = 0
        linked = 100 * common >= percent * (sizes + len(sets[i]) - common)
        for other in set(labels[members[linked]].tolist()):
            if other != labels[i] and forest.join(int(labels[i]), other):
                found.append((int(labels[i]), other))
    return found


def _blocks_linked(rows: DataFrame, percent: int) -> DataFrame:
    """Edges of the blocks ``hub``, ``i``, ``j``; rows of a block follow each other in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key = None

        def close() -> list[tuple[int, int]]:
            if not held:
                return []
            labels, asks, sets = zip(*held, strict=True)
            return _block_links(np.array(labels, dtype=np.int64), np.array(asks), list(sets), percent)

        for batch in batches:
            found: list[tuple[int, int]] = []
            hub, i, j, label, asks = (batch.column(k).to_pylist() for k in range(5))
            lists = batch.column(5)
            values, places = lists.values.to_numpy(), lists.offsets.to_numpy()
            for r in range(batch.num_rows):
                if (hub[r], i[r], j[r]) != key:
                    found += close()
                    held, key = [], (hub[r], i[r], j[r])
                held.append((label[r], asks[r], values[places[r] : places[r + 1]].copy()))
            yield _edges(found)
        yield _edges(close())
        release()

    def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = ([x[k] for x in found] for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Two documents are linked when 100 * common shingles >= ``percent`` * all shingles of both.
    ``component_id`` is the smallest id reachable by links.  Ids are whole numbers.  A null text
    counts as empty; texts without words are linked with nothing and stay.  Rows that repeat an id
    are one document to links: what one of its texts is linked with, all are.  A row with a null id
    belongs to the documents whose shingle set it has, and stays only if those have no id either.
    """
    small_batches(docs.sparkSession, size=2 << 20)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text).alias("text"))
    all_docs = materialise(_sketched(read, width, percent), "sketches")
    classes = all_docs.where(F.col("n") > 0).groupBy("digest").agg(F.min("doc_id").alias("rep"))

    first_ones = all_docs.join(
        classes.select(F.col("digest").alias("_d"), "rep"),
        (F.col("digest") == F.col("_d")) & (F.col("doc_id") == F.col("rep")),
        "left_semi",
    )
    bands = first_ones.select(F.col("doc_id").alias("rep"), "n", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    hits = materialise(bands.join(shared, "key"), "buckets")
    central = hits.groupBy("rep").agg(F.sum("c").alias("central"))
    hubs = (
        hits.join(central, "rep")
        .groupBy("key")
        .agg(F.max(F.struct("central", (-F.col("rep")).alias("less"), "n")).alias("h"))
        .select("key", (-F.col("h.less")).alias("hub"), F.col("h.n").alias("hub_n"))
    )
    stars = materialise(
        hits.join(hubs, "key").where("rep != hub").select("hub", "hub_n", "rep", "n").distinct(), "stars"
    )

    # Ids of candidates and their sets grow with the corpus: merged at every size, never broadcast.
    ids = stars.select(F.explode(F.array("hub", "rep")).alias("doc_id")).distinct().hint("merge")
    sets = materialise(_sets(read.join(ids, "doc_id", "left_semi"), width), "shingle-sets").hint("merge")
    similar = F.lit(100) * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    common = F.size(F.array_intersect("shingles", "hub_shingles"))
    linked = (
        stars.where(similar)
        .join(sets.withColumnsRenamed({"doc_id": "hub", "shingles": "hub_shingles"}), "hub")
        .join(sets.withColumnRenamed("doc_id", "rep"), "rep")
        .where(100 * common >= percent * (F.size("shingles") + F.size("hub_shingles") - common))
        .select(F.col("hub").alias("a"), F.col("rep").alias("b"))
    )
    first = materialise(components(linked, "star-links"), "star-components")

    def labelled(df: DataFrame, node: str, name: str) -> DataFrame:
        known = first.select(F.col("node").alias(node), F.col("component").alias(name))
        return df.join(known, node, "left").withColumn(name, F.coalesce(name, node))

    members = labelled(labelled(stars.select("hub", "rep"), "hub", "hub_label"), "rep", "label")
    members = materialise(members.withColumn("open", F.col("label") != F.col("hub_label")), "members")
    sides = (
        members.groupBy("hub")
        .agg(F.count(F.lit(1)).alias("m"), F.sum(F.col("open").cast("long")).alias("s"))
        .where("s > 0 and m > 1")
        .select("hub", F.ceil(F.col("s") / BLOCK).alias("asking"), F.ceil(F.col("m") / BLOCK).alias("asked"))
    )
    dealt = members.join(sides, "hub").withColumn("_h", F.xxhash64("rep"))
    as_member = dealt.select(
        "hub", "rep", "label", F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("asking") - 1)).alias("i"),
        F.pmod("_h", "asked").alias("j"),
    )
    as_asker = dealt.where("open").select(
        "hub", "rep", "label", F.lit(True).alias("asks"), F.pmod("_h", "asking").alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("asked") - 1)).alias("j"),
    )
    blocks = (
        as_member.unionByName(as_asker)
        .join(sets.withColumnRenamed("doc_id", "rep"), "rep")
        .select("hub", "i", "j", "label", "asks", "shingles")
        .repartition("hub", "i", "j")
        .sortWithinPartitions("hub", "i", "j")
    )
    second = components(_blocks_linked(blocks, percent), "block-links")

    named = labelled(classes, "rep", "label").join(
        second.select(F.col("node").alias("label"), F.col("component").alias("_later")), "label", "left"
    )
    named = named.select("digest", F.coalesce("_later", "label").alias("component_id"))
    # Texts without words have no class; of the others one class may hold a large part.
    with_words = split_join(all_docs.where("n > 0").select("digest", "doc_id", "n"), named, ["digest"])
    found = with_words.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        all_docs.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    )
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
