import hashlib
import re

import numpy as np
import pytest
from llm.brute import near_groups, vector_links

from tidewright.llm import exactdedup, lattice, minhash
from tidewright.llm.graph import components


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(docs_of, odd_rows, width, percent):
    got = minhash.near_duplicates(docs_of(odd_rows), width, percent).collect()
    want = near_groups(odd_rows, width, percent)
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_a_large_group_in_small_blocks(docs_of, odd_rows, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 4)
    got = minhash.near_duplicates(docs_of(odd_rows), 3, 90).collect()
    assert {r.doc_id: (r.component_id, r.n_shingles) for r in got} == near_groups(odd_rows, 3, 90)


def test_near_duplicates_without_rows_null_ids_and_clashing_columns(spark, docs_of):
    assert minhash.near_duplicates(docs_of([(1, "x")]).limit(0)).collect() == []
    rows = [(None, "a b c d e f"), (None, "other words here"), (4, "a b c d e f"), (4, "a b c d e f")]
    odd = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, key int, shingles string")
    got = [(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(odd).collect()]
    assert sorted(got, key=str) == [(4, 4, True), (4, 4, True), (None, 4, False), (None, None, True)]


def test_sketches_fill_and_agree_like_the_sets():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 3000).astype(np.uint64)
    for n in (1, 2, 7, 3000):
        assert (minhash.sketch(pool[:n], 160) < 2**64 - 1).all()
    a, b = pool[:2000], pool[500:2500]
    agree = (minhash.sketch(a, 2000) == minhash.sketch(b, 2000)).mean()
    assert abs(agree - 1500 / 2500) < 0.06


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)] + [(50, 60), (60, 55), (70, 70)]
    found = components(spark.createDataFrame(chain, "a long, b long"), "test").collect()
    got = {r.node: r.component for r in found}
    assert len(got) == len(found)
    assert got == {**dict.fromkeys(range(1, 41), 1), 50: 50, 55: 50, 60: 50}


def test_exact_duplicates(docs_of, odd_rows):
    rows = [*odd_rows, (500, "a  b \n c "), (501, odd_rows[7][1].replace(" ", "\n")), (502, odd_rows[7][1] + "!")]
    got = {r.doc_id: r for r in exactdedup.exact_duplicates(docs_of(rows)).collect()}
    normal = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in rows}
    assert len(got) == len(rows)
    for i, text in normal.items():
        same = [j for j, other in normal.items() if other == text]
        digest = hashlib.sha256(text.encode()).hexdigest()
        assert (got[i].keep_id, got[i].group_size, got[i].text_sha256) == (min(same), len(same), digest)
        assert got[i].kept == (i == min(same))


def test_exact_duplicates_when_chunk_names_collide(docs_of, monkeypatch):
    real = exactdedup.F.xxhash64
    monkeypatch.setattr(exactdedup.F, "xxhash64", lambda *c: real(*c) % 2)
    rows = [(i, f"text number {i // 2}") for i in range(20)]
    got = exactdedup.exact_duplicates(docs_of(rows)).collect()
    assert {r.doc_id: r.keep_id for r in got} == {i: i // 2 * 2 for i in range(20)}


def test_exact_duplicates_without_rows_and_with_null_ids(docs_of):
    assert exactdedup.exact_duplicates(docs_of([(1, "x")]).limit(0)).collect() == []
    got = exactdedup.exact_duplicates(docs_of([(None, "x"), (None, "y"), (3, "x")])).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in got), key=str) == [
        (3, 3, 2, True),
        (None, 3, 2, False),
        (None, None, 1, True),
    ]


def test_chunks_are_found_again_behind_a_change(docs_of, odd_rows):
    text = odd_rows[7][1]
    rows = exactdedup.recipes(docs_of([(1, text), (2, "Changed " + text)])).collect()
    names = [{c.name for c in r.chunks} for r in rows]
    assert len(names[0] & names[1]) > len(names[0]) / 2


def vectors(seed=1):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 5] + rng.normal(size=16) * 0.1).tolist()) for i in range(60)]
    rows += [(200 + i, base[7].tolist()) for i in range(5)] + [(210, (base[7] * 3).tolist())]
    rows += [(300, None), (301, []), (302, [0.0] * 16), (303, [None, *[1.0] * 15]), (304, [float("nan")] * 16)]
    return rows + [(305, [float("inf"), *[1.0] * 15]), (306, [1.0, 2.0]), (307, [1.0, 2.1])]


@pytest.mark.parametrize("block", [256, 3])
def test_near_vectors_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(lattice, "BLOCK", block)
    rows = vectors()
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, cells int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id) for r in lattice.near_vectors(table).collect()}
    assert got == vector_links(rows, 0.9)


def test_near_vectors_without_rows(spark):
    assert lattice.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_lattice_points_are_nearest_and_recall_is_high():
    rng = np.random.default_rng(4)
    y = rng.normal(size=(500, 8))
    point = lattice.nearest_point(y)
    around = point[:, None, :] + lattice.neighbours()
    assert (((y[:, None, :] - around) ** 2).sum(axis=2) >= ((y - point) ** 2).sum(axis=1)[:, None] - 1e-9).all()
    a = rng.normal(size=(600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * side / np.linalg.norm(side, axis=1, keepdims=True)
    p, q = lattice.cells(a), lattice.cells(b)
    meet = (p == q[:, :, :1]).any(axis=2) | (q == p[:, :, :1]).any(axis=2)
    assert meet.any(axis=1).mean() > 0.95


def test_chunks_are_found_again_behind_a_change(docs_of):
    """Texts that differ at their start, or in one word, share nearly all their chunks."""
    import random

    rng = random.Random(12)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    text = [rng.choice(words) for _ in range(4000)]
    changed = [*text[:2000], "other", *text[2001:]]
    rows = [(1, " ".join(text)), (2, "twelve more " + " ".join(text)), (3, " ".join(changed))]
    got = {r.doc_id: [c.name for c in r.chunks] for r in exactdedup.recipes(docs_of(rows)).collect()}
    assert 30 < len(got[1]) < 75
    assert len(set(got[1]) & set(got[2])) >= len(got[1]) - 2 and len(set(got[1]) & set(got[3])) >= len(got[1]) - 3


def test_cut_letters_in_texts_do_not_make_texts_equal(docs_of):
    """Letters that mark cuts inside: all these texts differ."""
    texts = ["a b", "a\x01 b", "a \x01b", "a\x01\x02 b", "a\x02 b", "a\x02\x01 b", "\x01", "\x01\x02", "\x02", "a\x01", "a"]
    big = [" ".join(["word", t, "next"] * 60) for t in texts]
    got = exactdedup.exact_duplicates(docs_of(list(enumerate(texts + big)))).collect()
    assert all(r.kept and r.group_size == 1 for r in got) and len(got) == 2 * len(texts)


def test_copies_of_columns_with_clashing_names(docs_of, odd_rows):
    docs = docs_of([*odd_rows, (1, "x"), (None, "x"), (None, "One")])
    clash = docs.selectExpr("*", "1 as names", "2 as recipe", "3 as chunks", "4 as normal", "5 as _doubt")
    plain = exactdedup.exact_duplicates(docs).collect()
    assert sorted(map(str, exactdedup.exact_duplicates(clash).collect())) == sorted(map(str, plain))
    assert exactdedup.exact_duplicates(clash.limit(0)).collect() == []
