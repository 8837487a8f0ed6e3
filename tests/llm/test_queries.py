"""The registered queries on the smallest tables against plain versions."""

import hashlib
import zlib

import numpy as np
import pytest
from llm.brute import near_groups, vector_links, water_levels
from tokenizers import Tokenizer

from tidewright.llm.queries import QUERIES, SQL
from tidewright.llm.tokens import default_path

FOLDER = "/root/testdata/sf0.001"
TYPES = {
    "op1_minhash_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op3_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op4_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_embedding_dedup": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op7_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op8_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op9_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op10_sharding": "doc_id bigint, size bigint, text_crc32 bigint, law string, shard int, slot bigint, grown_shard int",
}


def test_every_query_has_sql_or_a_test_of_its_own():
    tested = {"op11_whitening", "op13_conversation_repair"}  # in the tests of their modules
    assert set(QUERIES) == set(SQL) | set(TYPES) | tested


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "source").collect()
    return {r.doc_id: r for r in rows}


def run(spark, name, key="doc_id"):
    got = QUERIES[name](spark, FOLDER)
    kinds = dict(got.dtypes)
    assert all(kinds[c.split()[0]] == c.split()[1] for c in TYPES[name].split(", "))
    rows = got.collect()
    assert len(rows) == len({r[key] for r in rows})
    return {r[key]: r for r in rows}


def library(name):
    model = Tokenizer.from_file(default_path(name))
    model.no_truncation()
    model.no_padding()
    return model


def words_of(text):
    return (text or "").encode().split()


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


def test_op1(spark, docs):
    want = near_groups([(i, r.text) for i, r in docs.items()], 3, 85)
    got = run(spark, "op1_minhash_dedup")
    assert {i: (r.component_id, r.n_shingles) for i, r in got.items()} == want
    assert all(r.kept == (r.component_id == i) for i, r in got.items())


def test_op3_and_op9(spark, docs):
    model = library("word_bpe_49k.json")
    ids = {i: model.encode(r.text or "", add_special_tokens=False).ids for i, r in sorted(docs.items())}
    got = run(spark, "op3_token_counts")
    assert {i: (r.n_bytes, r.n_tokens, r.over_limit) for i, r in got.items()} == {
        i: (len((docs[i].text or "").encode()), len(x), len(x) > 2048) for i, x in ids.items()
    }
    want, start = {}, 0
    for i, x in ids.items():
        want[i] = (start, len(x) + 1, zlib.crc32(packed([*x, 1])))
        start += len(x) + 1
    assert {i: (r.start, r.n_tokens, r.ids_crc32) for i, r in run(spark, "op9_token_files").items()} == want


def test_op4(spark, docs):
    got = run(spark, "op4_quality")
    assert set(got) == set(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    unseen = [i for i, r in got.items() if r.held_out and i in labels]
    assert sum(got[i].predicted == labels[i] for i in unseen) >= 0.9 * len(unseen)


def test_op6(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    want = vector_links(rows, 0.9)
    got = run(spark, "op6_embedding_dedup", "vec_id")
    assert set(got) == set(want)
    assert all(got[i].n_links <= n for i, (n, _) in want.items())
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(n for n, _ in want.values())


def test_op7(spark, docs):
    model = library("byte_bpe_50k.json")
    for i, r in run(spark, "op7_bpe").items():
        ids = model.encode(docs[i].text or "", add_special_tokens=False).ids
        back = model.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_op8(spark, docs):
    got = run(spark, "op8_mixing")
    sizes = {i: len(words_of(r.text)) for i, r in docs.items()}
    per_source = {}
    for i, r in docs.items():
        per_source[r.source] = per_source.get(r.source, 0) + sizes[i]
    targets = water_levels(per_source, (1.0, 2.0, 3.0), 3.0)
    taken = dict.fromkeys(per_source, 0)
    for i, r in got.items():
        source = docs[i].source
        assert (r.size, r.source_size) == (sizes[i], per_source[source]) and r.target == pytest.approx(targets[source])
        assert r.taken <= 3 * r.size
        taken[source] += r.taken
    assert all(abs(taken[s] - targets[s]) <= max(sizes.values()) for s in taken)
    assert {i: r.taken for i, r in run(spark, "op8_mixing").items()} == {i: r.taken for i, r in got.items()}


def test_op10(spark, docs):
    got = run(spark, "op10_sharding")
    assert {i: (r.size, r.text_crc32, r.law, r.grown_shard) for i, r in got.items()} == {
        i: (len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode()), "rows", None) for i, r in docs.items()
    }
    for shard in range(8):
        slots = sorted(r.slot for r in got.values() if r.shard == shard)
        assert slots == list(range(len(slots))) and len(docs) // 8 <= len(slots) <= -(-len(docs) // 8)
