"""Shuffle rows into shards: a Feistel permutation over global row numbers.

Row numbers follow the order of the ids.  The permutation is computed, not stored, so the shard
and slot of any row number, and the row number at any shard and slot, need no table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import ship
from .minhash import mixed
from .support import numbered, text_of

ROUNDS = 6


def _half_bits(n: int) -> int:
    return max(1, (max(n - 1, 1).bit_length() + 1) // 2)


def _round_keys(seed: int) -> list[np.uint64]:
    return [np.uint64((seed * 0x9E3779B97F4A7C15 + k * 0xD6E8FEB86659FD93) % 2**64) for k in range(1, ROUNDS + 1)]


def _network(x: np.ndarray, n: int, keys: list[np.uint64]) -> np.ndarray:
    bits = np.uint64(_half_bits(n))
    mask = (np.uint64(1) << bits) - np.uint64(1)
    left, right = x >> bits, x & mask
    for key in keys:
        left, right = right, left ^ (mixed(right + key) & mask)
    return (right << bits) | left


def permute(rows: np.ndarray, n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """Positions of ``rows`` under a permutation of 0 … n-1 (``inverse``: rows at the positions).

    The network permutes a power of four below 4 n; a value that falls outside is sent through it
    again until it is inside (cycle walking), about four times at most on average.
    """
    keys = _round_keys(seed)
    keys = keys[::-1] if inverse else keys
    out = np.asarray(rows).astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        out[todo] = _network(out[todo], n, keys)
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def shard_rows(docs: DataFrame, shards: int, seed: int = 1, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``row``, ``shard`` and ``slot`` of every row.

    Shard sizes differ by at most one and slots run from 0 without gaps.  ``size`` is the UTF-8
    bytes of the text plus 1; a null text counts as empty.  A null id stands before all others.
    Rows equal in id, checksum and size may take each other's places.  An empty table gives none.
    Only ids, sizes and checksums are sorted; texts are not moved.
    """
    ship(docs.sparkSession)
    read = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text_of(text)).cast("long") + 1).alias("size"),
        F.crc32(text_of(text).cast("binary")).alias("text_crc32"),
    )
    rows, n = numbered(read, ["doc_id", "text_crc32", "size"], "shard-rows")

    @F.pandas_udf("long")
    def place(numbers: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in numbers:
            yield pd.Series(permute(part.to_numpy(), n, seed))

    at = F.col("_place")
    return rows.withColumn("_place", place("row")).select(
        *rows.columns, (at % shards).cast("int").alias("shard"), F.floor(at / F.lit(shards)).cast("long").alias("slot")
    )
