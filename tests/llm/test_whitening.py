import math
import random

import numpy as np
import pytest

from tidewright.llm import whitening
from tidewright.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def plainly(rows, components=16, by_count=False):
    """The fit over the distinct vectors with numpy and Python's integers."""
    x = {}
    for place, (_, v, *_) in enumerate(rows):
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            x[place] = tuple(math.floor(64 * float(np.float32(c))) + 1000000 for c in v)
    fit = list(x.values()) if by_count else sorted(set(x.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums, strict=True)] for v in fit])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = []
    for place, v in x.items():
        scaled = [n * a - s for a, s in zip(v, sums, strict=True)]
        z = np.array([s / n for s in scaled]) @ axes / np.sqrt(values)
        out += [(rows[place][0], k + 1, n, sum(s * s for s in scaled), z[k], values[k] / np.trace(centred.T @ centred / n)) for k in range(len(z))]
    return out


def compare(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[1], abs(r[4]))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert np.allclose([abs(r[4]) for r in got], [abs(r[4]) for r in want], atol=1e-6)
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert {r[6] < 1e-6 for r in got} == {True}


def vectors(n, dim, seed=1):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1 + j) for j in range(dim)], 0) for i in range(n)]


@pytest.mark.parametrize("weigh_by", ["one", "count"])
def test_against_numpy(spark, weigh_by):
    rows = vectors(60, 20)
    rows += [(100 + i, rows[0][1], 1) for i in range(40)] + [(5, rows[3][1], 0), (5, rows[3][1], 0), (None, rows[4][1], 0)]
    odd = [(200, None, 0), (201, [1.0] * 19 + [None], 0), (202, [float("nan")] * 20, 0), (203, [float("inf")] + [0.0] * 19, 0), (204, [], 0)]
    table = spark.createDataFrame(rows + odd, SCHEMA).repartition(4).selectExpr("*", "label as dim", "label as key", "'a' as x", "1 as n")
    got = whitening.whiten(table, weigh_by=weigh_by).collect()
    compare(got, plainly(rows, by_count=weigh_by == "count"))


def test_one_sign_for_all_rows(spark):
    rows = vectors(50, 5)
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    want = {r[:2]: r[4] for r in plainly(rows)}
    for k in range(1, 6):
        signs = {np.sign(r.whitened * want[r.vec_id, r.component]) for r in got if r.component == k and abs(r.whitened) > 1e-6}
        assert len(signs) == 1


def test_fewer_vectors_than_components_and_no_variance(spark):
    rows = vectors(3, 6)
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 18
    assert all((r.whitened is None) == (r.component > 2) for r in got)
    assert all(r.identity_error < 1e-6 for r in got)
    alike = whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0], 0) for i in range(4)], SCHEMA)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in alike] == [(1, 0, None, None)] * 8


def test_lengths_are_spaces_of_their_own_and_huge_entries_hold(spark):
    rows = vectors(30, 4) + [(100 + i, v, 0) for i, v, _ in vectors(25, 7, seed=2)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    compare([r for r in got if r.vec_id < 100], plainly(rows[:30]))
    compare([r for r in got if r.vec_id >= 100], plainly(rows[30:]))
    huge = [(0, [3e38, 1.0], 0), (1, [-3e38, 2.0], 0), (2, [0.0, 5.0], 0)]
    got = whitening.whiten(spark.createDataFrame(huge, SCHEMA)).collect()
    assert len(got) == 6 and {r.deviation for r in got if r.vec_id == 0} == {None}


def test_empty_table(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 0)], SCHEMA)).collect() == []


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    got = QUERIES["op11_whitening"](spark, folder)
    assert dict(got.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
        "explained": "double", "identity_error": "double",
    }
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(got.collect(), plainly(rows))
