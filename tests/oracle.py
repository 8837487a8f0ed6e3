"""Compare a Spark result with DuckDB on the same parquet files."""

from __future__ import annotations

import glob
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def _same(x: tuple, y: tuple, rel: float) -> bool:
    if x == y:
        return True
    return rel > 0 and all(
        a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, rel_tol=rel))
        for a, b in zip(x, y)
    )


def compare(df, con, sql: str, rel: float = 0.0) -> str | None:
    """None when both sides agree, else a short text saying how they differ.

    ``rel`` lets doubles differ by that part, for sums past the digits a double can hold.
    """
    got = df.collect()
    names = df.columns
    res = con.execute(sql)
    want_names = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} against {sorted(want_names)}"
    a, b = rows_of(names, got), rows_of(want_names, want)
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}; first {a[:1]} {b[:1]}"
    bad = [(x, y) for x, y in zip(a, b) if not _same(x, y, rel)]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ ({sorted(names)}): {bad[0][0]} against {bad[0][1]}"
    return None if a else "no rows on either side"
