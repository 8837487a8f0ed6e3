import base64
import glob
import gzip
import hashlib
import random

import pytest
from oracle import compare, connect

from tidewright.llm import warc
from tidewright.llm.queries import QUERIES, SQL

SCHEMA = "page_id long, url string, html string"


def made(n, payload, refers_to=None, digest=None):
    digest = digest or warc.base32_sha1(payload)
    return warc.record(n, f"http://x.org/{n}", payload, digest, len(payload), refers_to, "2020-01-01T00:00:00Z") + warc.END


def archive(compress, payloads):
    parts = [made(n, p) for n, p in enumerate(payloads)]
    return [gzip.compress(p) if compress else p for p in parts]


def pages_of(data):
    found = list(warc.records_in(data))
    # Every byte is in one record or gap.
    spans = sorted({(f.offset, f.length) for f in found})
    assert [a for a, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]
    assert sum(n for _, n in spans) == len(data)
    return [int(f.fields["x-page-id"]) for f in found if not f.problem], [(f.offset, f.length) for f in found if f.problem]


PAYLOADS = [b"", b"plain", bytes(range(256)) * 40, b"line\nWARC/1.1\r\nWARC-Type: response\r\n", b"\x1f\x8b\x08 not a member", b"last"]


@pytest.mark.parametrize("compress", [True, False])
def test_whole_archives_and_every_kind_of_damage(compress):
    parts = archive(compress, PAYLOADS)
    data, starts = b"".join(parts), [sum(map(len, parts[:k])) for k in range(len(parts) + 1)]
    assert pages_of(data) == (list(range(6)), [])
    for k in range(len(parts)):
        others = [n for n in range(6) if n != k]
        middle = (starts[k] + starts[k + 1]) // 2
        flipped = data[:middle] + bytes([data[middle] ^ 255]) + data[middle + 1 :]
        assert pages_of(flipped) == (others, [(starts[k], len(parts[k]))])
        beheaded = data[: starts[k]] + data[starts[k] + 5 :]
        assert pages_of(beheaded) == (others, [(starts[k], len(parts[k]) - 5)])
        cut = data[:middle] + data[starts[k + 1] :]
        assert pages_of(cut) == (others, [(starts[k], middle - starts[k])])
        junk = data[: starts[k]] + b"WARC/1.1 junk\x1f\x8b\x08junk" + data[starts[k] :]
        assert pages_of(junk) == (list(range(6)), [(starts[k], 20)])
    assert pages_of(data[: starts[5] + 9]) == (list(range(5)), [(starts[5], 9)])
    assert pages_of(b"") == ([], []) and pages_of(b"nothing") == ([], [(0, 7)])


def test_a_record_inside_a_payload_is_no_record_even_if_a_digest_fails():
    inner = made(77, b"inner")
    outer = made(1, b"x\n" + inner + b"y", digest=warc.base32_sha1(b"other"))
    assert pages_of(outer + made(2, b"z")) == ([2], [(0, len(outer))])


def test_many_random_losses():
    rng = random.Random(4)
    for compress in (True, False):
        payloads = [rng.randbytes(rng.randint(0, 400)) for _ in range(60)]
        parts = archive(compress, payloads)
        for _ in range(40):
            bad = set(rng.sample(range(60), 5))
            # Plain heads have no checksum, so plain records lose bytes of their blocks.
            at = [len(p) // 3 if compress else p.index(b"HTTP/1.1 200") + 3 for p in parts]
            hurt = [p[:a] + p[a + rng.randint(1, 9) :] if k in bad else p for k, (p, a) in enumerate(zip(parts, at, strict=True))]
            assert pages_of(b"".join(hurt))[0] == [n for n in range(60) if n not in bad]


def table(spark):
    long = "é" * 300_000 + "\r\n\r\nWARC/1.1\r\n"
    rows = [(1, "http://a/", "same"), (2, "http://b/\r\nX: y", "same"), (3, None, "same"), (4, "http://é/?q=a b", "other"), (5, "", None),
            (6, "http://c", ""), (None, "http://n", "same"), (None, "http://n", "alone"), (7, "u", long), (8, "u", "twice"), (8, "v", "twice")]
    rows += [(100 + i, "http://hot", "hot") for i in range(30)]
    odd = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return rows, odd.selectExpr("*", "'z' as payload", "1 as digest", "2 as size", "html as record", "3 as keeper")


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("least", [0, 4])
def test_round_trip(spark, tmp_path, compress, least):
    rows, pages = table(spark)
    folder = str(tmp_path / "archives")
    warc.write_archives(pages, folder, compress=compress, archive_bytes=100_000, least_bytes=least)
    found = warc.read_archives(spark, folder)
    assert warc.gap_log(found).collect() == []
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "").encode() == body and p is not None]
        keeper = max(same) if same and len(body) >= least else page
        kind = ("response", None) if keeper == page else ("revisit", keeper)
        want.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), *kind))
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, warc.page_records(found).collect()), key=lambda r: str(key(r))) == sorted(want, key=lambda r: str(key(r)))
    bodies = {r.page_id: (r.payload.decode(), r.target_uri) for r in found.where("record_type = 'response'").collect() if r.page_id}
    texts = {p: h or "" for p, _, h in rows}
    assert all(b == texts[p] for p, (b, _) in bodies.items())
    assert bodies[4][1] == "http://%C3%A9/?q=a%20b"
    named = {r.record_id for r in found.collect() if r.record_type == "response"}
    assert len(glob.glob(f"{folder}/part-*")) > 3 and len(named) > 5
    if compress:
        for file in glob.glob(f"{folder}/part-*"):
            with gzip.open(file) as stream:  # any reader of gzip takes the members
                assert stream.read().count(b"WARC-Record-ID") >= 0


def test_damaged_files_are_salvaged_and_logged(spark, tmp_path):
    parts = archive(True, PAYLOADS)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts[:2]) + b"lost" + b"".join(parts[2:]))
    (tmp_path / "b.warc").write_bytes(b"".join(archive(False, PAYLOADS))[:-3])
    (tmp_path / "empty.warc").write_bytes(b"")
    found = warc.read_archives(spark, str(tmp_path))
    log = {r.file.rsplit("/", 1)[1]: (r.offset, r.length, r.problem) for r in warc.gap_log(found).collect()}
    assert log["a.warc.gz"] == (len(parts[0]) + len(parts[1]), 4, "no record header")
    assert set(log) == {"a.warc.gz", "b.warc"} and log["b.warc"][1] == len(made(5, b"last")) - 3
    assert warc.page_records(found).count() == 11


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "archives")
    warc.write_archives(spark.createDataFrame([], SCHEMA), folder)
    assert warc.page_records(warc.read_archives(spark, folder)).collect() == []


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    assert compare(QUERIES["op12_warc"](spark, folder), connect(folder), SQL["op12_warc"]) is None
