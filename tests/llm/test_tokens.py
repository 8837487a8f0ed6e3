import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidewright.llm import bpe, tokencounts, tokenfiles, tokens
from tidewright.llm.tokens import Encoder, default_path

WORD, BYTE, PIECE = map(default_path, ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
PIECES = st.lists(
    st.sampled_from(
        ["a", "the", "The", "ING", "don't", "'ll", " ", "  ", "   ", "\n", "\t", "\xa0", "\x1c", "\x85", "\u2003", "é", "e\u0301",
         "H\u0331", "İ", "Σ", "日本", "🙂", "123", "٣", "==", "...", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "\u200b", "\U00010940"]
    ),
    max_size=14,
).map("".join)


def library(path):
    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return model


@pytest.fixture(scope="module")
def word_library():
    return library(WORD)


@pytest.fixture(scope="module")
def byte_library():
    return library(BYTE)


@pytest.fixture(scope="module")
def byte_codec():
    return bpe.ByteCodec(BYTE, budget=4000)


def packed(ids):
    return np.array(ids, dtype="<u4").tobytes()


WORDS = Encoder(WORD, by_words=True, budget=4000)


@settings(max_examples=300, deadline=None)
@given(text=PIECES)
def test_ids_by_words_are_those_of_the_whole_text(word_library, text):
    assert WORDS.encode([text.encode()]) == [packed(word_library.encode(text, add_special_tokens=False).ids)]


LATIN = st.text("aeéÉßÿŸİŉĲſ'sStTrReEvVlLdDmM09²½!?-…«_ \n", max_size=40)


@settings(max_examples=600, deadline=None)
@given(text=LATIN | st.text(max_size=40) | st.text(st.characters(max_codepoint=0x180), max_size=60))
def test_words_merged_at_once_equal_the_library(word_library, text):
    assert WORDS.encode([text.encode("utf-8", "replace")]) == [packed(word_library.encode(text.encode("utf-8", "replace").decode(), add_special_tokens=False).ids)]


def test_columns_of_texts_and_one_long_text(word_library):
    import pyarrow as pa

    texts = [None, "", " ", "It's", "l'été 日本", "<|endoftext|> x", "word " * 50_000, "ab" * 300_000, "x"]
    ids, counts = WORDS.encode_column(pa.array(["cut", *texts, "cut"])[1:-1])
    want = [word_library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == [i for x in want for i in x]
    assert WORDS.count_column(pa.array(texts)).tolist() == counts.tolist()
    assert WORDS.encode_column(pa.array([], pa.string()))[1].tolist() == []


def test_what_is_remembered_is_bounded_in_bytes():
    memo = tokens.Memo(budget=20_000, longest=8)
    for k in range(300):
        keys = {f"w{k}-{i}" for i in range(10)} | {"often", "x" * 5000 + str(k)}
        known = memo.fill(keys, lambda missing: [m.upper() for m in missing])
        assert all(known[x] == x.upper() for x in keys)
        assert memo.size <= 20_000 and len(memo.young) + len(memo.old) < 200
    assert "often" in memo.young and not any(len(k) > 8 for k in memo.old)


@settings(max_examples=300, deadline=None)
@given(text=PIECES | st.text(max_size=30) | st.text("abcinorest", max_size=60))
def test_byte_pairs_equal_the_library(byte_library, byte_codec, text):
    ids = byte_library.encode(text, add_special_tokens=False).ids
    assert byte_codec.encode([text.encode()]) == [packed(ids)]
    assert byte_codec.decode([packed(ids)]) == [byte_library.decode(ids, skip_special_tokens=False)]


def test_exact_merging_equals_the_library_alone(byte_library, byte_codec):
    for word in ["a" * n for n in range(1, 40)] + ["ab" * 300, "interestingly", "xqzzzjk"]:
        assert byte_codec.merges.exact(word) == byte_library.encode(word, add_special_tokens=False).ids


def test_token_counts_and_the_cache(spark, docs_of, odd_rows, word_library, tmp_path):
    cache, docs = str(tmp_path / "cache"), docs_of([*odd_rows, (8, odd_rows[7][1]), (None, "null id")])
    want = {i: len(word_library.encode(t or "", add_special_tokens=False).ids) for i, t in [*odd_rows, (None, "null id")]}
    got = tokencounts.token_counts(docs, WORD, cache, by_words=True, limit=100).collect()
    assert len(got) == len(odd_rows) + 2
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 100) for r in got)
    assert {r.doc_id: r.n_bytes for r in got}[400] == len(dict(odd_rows)[400].encode())
    stored = spark.read.parquet(cache).count()
    again = tokencounts.token_counts(docs_of([*odd_rows, (9, "brand new")]), WORD, cache, by_words=True).collect()
    assert {r.doc_id: r.n_tokens for r in again}[9] == len(word_library.encode("brand new", add_special_tokens=False).ids)
    assert spark.read.parquet(cache).count() == stored + 1
    assert tokencounts.token_counts(docs.limit(0), WORD, str(tmp_path / "none"), by_words=True).collect() == []


def test_token_counts_with_a_sentence_piece_model(docs_of, odd_rows, tmp_path):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = tokencounts.token_counts(docs_of(odd_rows[3:7]), PIECE, str(tmp_path / "cache")).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(model.encode(t)) for i, t in odd_rows[3:7]}


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files(spark, docs_of, odd_rows, word_library, tmp_path, encoding):
    folder, rows = str(tmp_path / "ids"), sorted(odd_rows)
    tokenfiles.write_token_files(docs_of(rows), folder, WORD, end_id=1, by_words=True, encoding=encoding)
    got = tokenfiles.with_checksums(tokenfiles.read_token_files(spark, folder)).orderBy("doc_id").collect()
    ids = [[*word_library.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows]
    assert [r.ids for r in got] == ids
    assert [r.start for r in got] == [sum(map(len, ids[:k])) for k in range(len(ids))]
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x), zlib.crc32(packed(x))) for x in ids]


def test_token_files_without_rows(spark, docs_of, tmp_path):
    folder = str(tmp_path / "ids")
    tokenfiles.write_token_files(docs_of([(1, "x")]).limit(0), folder, WORD, end_id=1, by_words=True)
    assert tokenfiles.with_checksums(tokenfiles.read_token_files(spark, folder)).collect() == []


def test_token_files_have_the_chosen_layout(spark, docs_of, odd_rows, tmp_path):
    import glob

    import pyarrow.parquet as pq

    folder = str(tmp_path / "ids")
    tokenfiles.write_token_files(docs_of(odd_rows), folder, WORD, end_id=1, by_words=True)
    group = pq.ParquetFile(glob.glob(f"{folder}/*.parquet")[0]).metadata.row_group(0)
    columns = {group.column(k).path_in_schema: group.column(k) for k in range(group.num_columns)}
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index


def scanned_rows(df) -> list[int]:
    """Rows that each Parquet scan of an executed plan gave."""
    df.collect()
    left, found = [df._jdf.queryExecution().executedPlan()], []
    while left:
        node = left.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            left.append(node.executedPlan())
        elif "QueryStage" in name:
            left.append(node.plan())
        elif name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        left += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_chosen_documents_are_read_by_page(spark, docs_of, word_library, tmp_path):
    folder, rows = str(tmp_path / "ids"), [(i, f"word{i} and {i % 7}") for i in range(6000)]
    tokenfiles.write_token_files(docs_of(rows), folder, WORD, end_id=1, by_words=True, page_rows=100)
    every = {r.doc_id: (r.start, r.ids) for r in tokenfiles.read_token_files(spark, folder).collect()}
    chosen = tokenfiles.read_token_files(spark, folder, [17, 4321, 99999])
    assert {r.doc_id: (r.start, r.ids) for r in chosen.collect()} == {i: every[i] for i in (17, 4321)}
    assert min(scanned_rows(chosen)) <= 400  # of the scan of ids; the one of the counts reads all


def test_token_files_of_null_and_equal_ids_and_clashing_columns(spark, docs_of, word_library, tmp_path):
    folder, rows = str(tmp_path / "ids"), [(None, "b c"), (3, "x"), (3, "x"), (3, None), (None, "a"), (1, "y")]
    docs = docs_of(rows).selectExpr("*", "1 as part", "2 as ids", "3 as local_start", "4 as n_tokens", "5 as _before")
    tokenfiles.write_token_files(docs, folder, WORD, end_id=1, by_words=True)
    got = tokenfiles.with_checksums(tokenfiles.read_token_files(spark, folder)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, 1, 3, 3, 3]
    ends = [0, *np.cumsum([r.n_tokens for r in got]).tolist()]
    assert [r.start for r in got] == ends[:-1] and all(r.n_tokens == len(r.ids) for r in got)
    texts = sorted((r.doc_id or 0, r.ids) for r in got)
    assert texts == sorted((i or 0, [*word_library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows)


def test_counts_of_clashing_columns_and_round_trips_of_odd_ids(docs_of, odd_rows, word_library, byte_library, tmp_path):
    docs = docs_of([*odd_rows, odd_rows[3], (None, "x"), (None, None)]).selectExpr("*", "1 as digest", "2 as version", "3 as n_tokens", "4 as _id")
    got = tokencounts.token_counts(docs, WORD, str(tmp_path / "cache"), by_words=True).collect()
    assert len(got) == len(odd_rows) + 3
    assert sorted(r.n_tokens for r in got if r.doc_id is None) == [0, len(word_library.encode("x", add_special_tokens=False).ids)]
    trips = bpe.round_trip(docs, BYTE).collect()
    assert len(trips) == len(odd_rows) + 3 and sorted(r.n_tokens for r in trips if r.doc_id is None) == [0, 1]


def test_round_trip(docs_of, odd_rows, byte_library):
    docs = docs_of(odd_rows).withColumnRenamed("lang", "ids").withColumnRenamed("n_chars", "decoded")
    got = {r.doc_id: r for r in bpe.round_trip(docs, BYTE).collect()}
    for i, text in odd_rows:
        ids = byte_library.encode(text or "", add_special_tokens=False).ids
        back = byte_library.decode(ids, skip_special_tokens=False)
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(packed(ids)).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()
    assert bpe.round_trip(docs.limit(0), BYTE).collect() == []
