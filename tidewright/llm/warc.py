"""Web archives: one record per page, repeated payloads as revisits, and a reader that salvages.

Payloads are compared by digest in a table of ids and digests alone.  Records are dealt evenly by
page over as many archives as their bytes ask for, and Spark's own writer stores them, so any file
system it knows will do.  Every record is a gzip member of its own, or plain text.

The reader checks each record's frame, its length, the checksum of its member and the digests of
block and payload.  Where a check fails it looks for the next place at which a whole record can be
read, goes on there, and reports the bytes in between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..durable import materialise
from ..operators.skew import split_join
from .support import ship, text_of

# Fixed values of the archive and compression formats.
VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
END = b"\r\n\r\n"
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff03000000000000000000")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: An extension field, the last of a head: checksum of the bytes before it, which no other field covers.
HEAD_CRC = b"X-Head-CRC32: "

#: Payload bytes an archive is meant to hold.
ARCHIVE_BYTES = 32 << 20
_STEP = 1 << 16
_BATCH_BYTES = 8 << 20
# Bytes may be lost in the middle of a line, so a version line can follow anything.
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[0-9]\r\n")
_REPEATED = {"warc-concurrent-to", "warc-protocol"}
_SAFE_URI = "!#$%&'()*+,/:;=?@[]~"

_FOUND = (
    "file string, offset long, length long, problem string, record_type string, record_id string, target_uri string,"
    " page_id long, refers_to long, payload_bytes long, payload_digest string, payload binary"
)


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page {page} {digest}')}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, size: int, refers_to: int | None, date: str) -> bytes:
    """A response, or with ``refers_to`` a revisit without payload; ends with the header's blank line and the block."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(page, digest)),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else urllib.parse.quote(url, safe=_SAFE_URI)),
        ("X-Page-ID", page),
        ("X-Refers-To-Page-ID", refers_to),
        ("WARC-Refers-To", _record_id(refers_to, digest) if revisit else None),
        ("WARC-Profile", REVISIT_PROFILE if revisit else None),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", len(block)),
    ]
    head = VERSION + b"\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None).encode()
    return head + HEAD_CRC + b"%08x" % zlib.crc32(head) + END + block


def _packed(data: bytes) -> bytes:
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def revisits(narrow: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id``, ``digest`` and ``keeper`` of the copies that refer to another page.

    Of equal payloads (``digest``) of at least ``least_bytes`` bytes (``size``) the largest page id
    is kept; rows that share the largest id are all responses.
    """
    large = narrow.where(F.col("size") >= least_bytes).select("page_id", "digest")
    keepers = large.groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("c")).where("c > 1")
    copies = split_join(large, keepers.drop("c"), ["digest"])
    return copies.where("not (page_id <=> keeper)").distinct()


def write_archives(
    pages: DataFrame,
    folder: str,
    compress: bool = True,
    archive_bytes: int = ARCHIVE_BYTES,
    least_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id",
    url: str = "url",
    payload: str = "html",
) -> None:
    """Write one record per row to the new ``folder``, in archives of about ``archive_bytes`` payload.

    Of equal payloads of at least ``least_bytes`` bytes the row with the largest id is a response
    and the others are revisits that name it; smaller payloads are all responses.  A null payload
    is empty, a null url leaves out the target, a null id is smaller than any other and left out
    too.  Rows that repeat both id and payload are each written as what the first of them is.
    Characters that a header cannot hold are percent-coded in the target.  Only the three named
    columns are read, so others may have any name.  An empty table gives archives without records.
    """
    ship(pages.sparkSession)
    read = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url).alias("url"), text_of(payload).cast("binary").alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    narrow = materialise(read.select("page_id", "digest", F.octet_length("payload").cast("long").alias("size")), "page-digests")
    total = narrow.agg(F.coalesce(F.sum(F.col("size") + 512), F.lit(0)).alias("n")).first()["n"]
    archives = int(total // archive_bytes) + 1
    # Both sides are dealt alike, so the payloads move once; a null id is a value like any other.
    key = ["_named", "_id", "digest"]

    def keyed(df: DataFrame) -> DataFrame:
        named = df.withColumn("_named", F.col("page_id").isNotNull()).withColumn("_id", F.coalesce("page_id", F.lit(0).cast("long")))
        return named.repartition(archives, *key)

    dealt = keyed(read).join(keyed(revisits(narrow, least_bytes)).drop("page_id"), key, "left")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page, link, body, digest, keeper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                name = base64.b32encode(bytes.fromhex(digest)).decode()
                made = record(page, link, body, name, len(body), keeper, date)
                out.append(_packed(made + END) if compress else made)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    records = dealt.select("page_id", "url", "payload", "digest", "keeper").mapInArrow(packed, "record binary")
    # What the writer puts behind each row: the end of a plain record, or a member without content.
    behind = EMPTY_MEMBER if compress else END
    records.select(F.col("record").cast("string")).write.mode("error").options(
        encoding="ISO-8859-1", lineSep=behind.decode("latin-1"), compression="none"
    ).text(folder)


class Found(NamedTuple):
    """A record, or a gap if ``problem`` says why its bytes could not be read."""

    offset: int
    length: int
    problem: str | None
    fields: dict[str, str]
    block: bytes


class Damaged(Exception):
    """No whole record starts here; ``end`` is where one with a sound frame would have ended."""

    def __init__(self, problem: str, end: int | None = None) -> None:
        super().__init__(problem)
        self.problem, self.end = problem, end


def _member(data: memoryview, at: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at ``at``."""
    inflate, out, place = zlib.decompressobj(31), [], at
    try:
        while not inflate.eof and place < len(data):
            out.append(inflate.decompress(data[place : place + _STEP]))
            place += _STEP
    except zlib.error:
        raise Damaged("member does not inflate") from None
    if not inflate.eof:
        raise Damaged("member is cut off")
    return b"".join(out), min(place, len(data)) - len(inflate.unused_data)


def _plain(data: bytes | memoryview, at: int) -> tuple[dict[str, str], bytes, int]:
    """Fields, block and end of the plain record at ``at``."""
    head = bytes(data[at : at + _STEP])
    close = head.find(END)
    lines = head[: max(close, 0)].split(b"\r\n")
    if close < 0 or not re.fullmatch(rb"WARC/1\.\d", lines[0]):
        raise Damaged("no record header")
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        name = name.strip().lower()
        if not colon or name in fields and name not in _REPEATED:
            raise Damaged("malformed header")  # twice the same field: the heads of two records run together
        fields[name] = value.strip()
    length = fields.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Damaged("no content length")
    start = at + close + len(END)
    end = start + int(length)
    if bytes(data[end : end + len(END)]) != END:
        raise Damaged("length does not lead to the record's end")
    block = bytes(data[start:end])
    end += len(END)
    if lines[-1].startswith(HEAD_CRC) and lines[-1] != HEAD_CRC + b"%08x" % zlib.crc32(head[: close - len(lines[-1])]):
        raise Damaged("head checksum differs", end)
    digest = fields.get("warc-block-digest", "")
    if digest.startswith("sha1:") and digest[5:] != base32_sha1(block):
        raise Damaged("block digest differs", end)
    digest = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") == "response" and digest.startswith("sha1:") and digest[5:] != base32_sha1(payload_of(fields, block)):
        raise Damaged("payload digest differs", end)
    return fields, block, end


def _is_http(fields: dict[str, str]) -> bool:
    return fields.get("content-type", "").startswith("application/http")


def payload_of(fields: dict[str, str], block: bytes) -> bytes:
    """The block without the header of the transfer protocol."""
    return block.partition(END)[2] if _is_http(fields) else block


def _records_at(view: memoryview, at: int) -> tuple[list[tuple[dict[str, str], bytes]], int]:
    """Records of the member or plain record at ``at``, and where it ends."""
    if view[at : at + len(MEMBER)] != MEMBER:
        fields, block, end = _plain(view, at)
        return [(fields, block)], end
    content, end = _member(view, at)
    read, inner = [], 0
    try:
        while inner < len(content):
            fields, block, inner = _plain(content, inner)
            read.append((fields, block))
    except Damaged as damage:
        raise Damaged(damage.problem, end) from None
    return read, end


def records_in(data: bytes) -> Iterator[Found]:
    """Records and gaps of one archive, in order; together they cover every byte of it.

    A member may hold several records or none.  If the frame is sound and only a digest differs,
    reading goes on behind the record, so lines inside it are not taken for records; else the next
    member or version line is tried, and the one after it, until a whole record is found.
    """
    view, at, bad_from, why = memoryview(data).cast("B"), 0, -1, ""
    while at < len(view):
        try:
            read, end = _records_at(view, at)
        except Damaged as damage:
            if bad_from < 0:
                bad_from, why = at, damage.problem
            following = None if damage.end else _START.search(view, at + 1)
            at = damage.end or (following.start() if following else len(view))
            continue
        if bad_from >= 0:
            yield Found(bad_from, at - bad_from, why, {}, b"")
            bad_from = -1
        for fields, block in read:
            yield Found(at, end - at, None, fields, block)
        at = end
    if bad_from >= 0:
        yield Found(bad_from, len(view) - bad_from, why, {}, b"")


def _number(text: str | None) -> int | None:
    known = text is not None and re.fullmatch(r"-?[0-9]{1,19}", text)
    return int(text) if known and -(1 << 63) <= int(text) < 1 << 63 else None


def _described(file: str, found: Found) -> tuple:
    fields = found.fields
    kind = fields.get("warc-type")
    payload = payload_of(fields, found.block)
    size: int | None = len(payload)
    if kind == "revisit":  # its block has the header alone, which states the length of the payload
        stated = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", found.block)
        size = int(stated[1]) if stated else None
    return (
        file, found.offset, found.length, found.problem, kind, fields.get("warc-record-id"), fields.get("warc-target-uri"),
        _number(fields.get("x-page-id")), _number(fields.get("x-refers-to-page-id")), None if found.problem else size,
        fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, None if found.problem or kind == "revisit" else payload,
    )


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Records and gaps of all archives under ``folder``.

    A row has ``file``, ``offset`` and ``length`` in the archive, and either ``problem``, for bytes
    that were quarantined, or what the record says: ``record_type``, ``record_id``, ``target_uri``,
    ``page_id``, ``refers_to``, ``payload_bytes`` and ``payload_digest`` of the full payload, and
    the payload of records that carry it.  An archive is read by one task and may have 2 GB, which
    is the limit of Spark's reader for whole files; ``write_archives`` stays far below it.
    """
    ship(spark)
    names, types = zip(*(x.split() for x in _FOUND.split(",")), strict=True)
    kinds = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[t] for t in types]

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=list(names))

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held, size = [], 0
                for found in records_in(content.as_buffer()):
                    row = _described(file, found)
                    held.append(row if with_payload else (*row[:-1], None))
                    size += 200 + with_payload * len(found.block)
                    if size > _BATCH_BYTES:
                        yield as_batch(held)
                        held, size = [], 0
                yield as_batch(held)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "content").mapInArrow(parsed, _FOUND)


def gap_log(found: DataFrame) -> DataFrame:
    """The quarantined bytes: ``file``, ``offset``, ``length`` and ``problem``."""
    return found.where("problem is not null").select("file", "offset", "length", "problem")


def page_records(found: DataFrame) -> DataFrame:
    """One row per record of a page: ``page_id``, length and digest of its payload, its type and what it refers to."""
    kept = found.where(F.col("problem").isNull() & F.col("record_type").isin("response", "revisit"))
    return kept.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _base32_sql(digest: str) -> str:
    """Base-32 letters of a hexadecimal digest in DuckDB: four letters for every five digits."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    value = f"('0x' || substr({digest}, 5 * k + 1, 5))::INT"
    four = " || ".join(f"substr('{alphabet}', ({value} >> {shift}) % 32 + 1, 1)" for shift in (15, 10, 5, 0))
    return f"array_to_string(list_transform(range(8), lambda k: {four}), '')"


def pages_sql() -> str:
    """The rows of ``page_records`` over the table ``pages``, for DuckDB."""
    return f"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        d AS (SELECT page_id, octet_length(payload) AS payload_bytes, {_base32_sql('sha1(payload)')} AS payload_digest FROM p),
        k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM d)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
        FROM k
    """
