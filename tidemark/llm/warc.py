"""WARC archives that store each payload once, by its digest.

An archive is two tables in a shared folder. ``payloads`` holds every different payload
once, compressed, under its SHA-256. ``records`` holds the exact header bytes of every
record, the digest of its payload, and nothing of the payload. A join of the two gives
back the bytes of every original record, whose digests are computed anew and compared.

Only digests and lengths are shuffled to find equal payloads; the payloads themselves are
reduced to one per digest before they leave their task.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import column, new_run_dir, record_batches, short_batches

#: Smallest payload, in bytes, that a revisit record may stand for.
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

_ADDRESSED = "page_id long, url string, address string, sha1 string, size long"
RECORD = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def _addressed(pages: DataFrame, with_payload: bool) -> DataFrame:
    """Digests and size of each row's payload, and the compressed payload if asked for."""
    fields = [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("address", pa.string()),
        ("sha1", pa.string()),
        ("size", pa.int64()),
    ]
    schema = pa.schema(fields + ([("packed", pa.binary())] if with_payload else []))

    def digest(batches):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            rows = []
            for page_id, url, html in zip(
                column(batch, "page_id"), column(batch, "url"), column(batch, "html"), strict=True
            ):
                payload = (html or "").encode()
                row = (
                    page_id,
                    url,
                    hashlib.sha256(payload).hexdigest(),
                    hashlib.sha1(payload).hexdigest(),
                    len(payload),
                )
                rows.append((*row, pack(payload)) if with_payload else row)
            yield from record_batches(rows, schema)

    narrow = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return narrow.mapInArrow(digest, _ADDRESSED + ", packed binary" * with_payload)


def record_header(
    page_id: int | None, copy: int, url: str | None, sha1: str, size: int, refers_to: tuple | None
) -> bytes:
    """Header lines of a record and of the HTTP message in it, up to the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {size}\r\n\r\n"
    )
    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
    uri = "" if url is None else "".join(c for c in url if c not in "\r\n")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_name(page_id, copy)}>",
        f"WARC-Date: {DATE}",
        *([] if url is None else [f"WARC-Target-URI: {uri}"]),
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_name(*refers_to)}>"]
    block = len(http) + (size if refers_to is None else 0)
    lines.append(f"Content-Length: {block}")
    return ("\r\n".join(lines) + "\r\n\r\n" + http).encode()


def _name(page_id: int | None, copy: int) -> str:
    return f"urn:page:{'none' if page_id is None else page_id}:{copy}"


def write_archive(pages: DataFrame, path: str, revisit_bytes: int = REVISIT_BYTES) -> None:
    """Write ``pages (page_id, url, html)`` as an archive.

    A null html is an empty payload; a null url leaves its header out. Of equal payloads of
    at least ``revisit_bytes`` the largest ``page_id`` is the response. Rows that repeat
    with the same page_id and payload are numbered; the first is the response.
    """
    spark = pages.sparkSession
    short_batches(spark)
    stored = _addressed(pages, True).groupBy("address").agg(
        F.first("sha1").alias("sha1"), F.first("size").alias("size"), F.first("packed").alias("packed")
    )
    stored.write.parquet(f"{path}/payloads")

    rows = _addressed(pages, False)
    numbered = rows.groupBy("address", "page_id", "url", "sha1", "size").agg(
        F.count(F.lit(1)).alias("copies")
    )
    # url may differ between rows of one page: number them on from each other.
    per_page = numbered.groupBy("address", "page_id", "sha1", "size").agg(
        F.sort_array(F.collect_list(F.struct("url", "copies"))).alias("rows")
    )
    newest = per_page.groupBy("address").agg(F.max("page_id").alias("newest"))
    joined = per_page.join(newest, "address")

    schema = pa.schema([("page_id", pa.int64()), ("address", pa.string()), ("header", pa.binary())])

    def write_headers(batches):
        for batch in batches:
            names = ("page_id", "newest", "address", "sha1", "size", "rows")
            yield from record_batches(
                _headers(zip(*(column(batch, n) for n in names), strict=True), revisit_bytes), schema
            )

    joined.mapInArrow(write_headers, "page_id long, address string, header binary").write.parquet(
        f"{path}/records"
    )


def _headers(rows, revisit_bytes):
    for page_id, newest, address, sha1, size, group in rows:
        copy = 0
        for each in group:
            for _ in range(each["copies"]):
                first = page_id == newest and copy == 0
                response = size < revisit_bytes or first
                refers_to = None if response else (newest, 0)
                yield page_id, address, record_header(page_id, copy, each["url"], sha1, size, refers_to)
                copy += 1


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive, put together again and checked: type, digest, size, reference."""
    short_batches(spark)
    records = spark.read.schema("page_id long, address string, header binary").parquet(
        f"{path}/records"
    )
    payloads = spark.read.schema(
        "address string, sha1 string, size long, packed binary"
    ).parquet(f"{path}/payloads")
    joined = records.join(payloads.select("address", "packed"), "address", "left")

    def parse(batches):
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = zip(*(column(batch, n) for n in ("address", "header", "packed")), strict=True)
            yield from record_batches((_parsed(unpack, *row) for row in rows), RECORD)

    return joined.select("address", "header", "packed").mapInArrow(
        parse,
        "page_id long, url string, payload_bytes long, payload_digest string, "
        "record_type string, refers_to long",
    )


def rebuild(header: bytes, payload: bytes) -> bytes:
    """The bytes of the original record; a revisit holds no payload."""
    revisit = b"\r\nWARC-Type: revisit\r\n" in header
    return header + (b"" if revisit else payload) + END


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields of a record and its block."""
    head, _, rest = record.partition(END)
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    size = int(fields["Content-Length"])
    if rest[size:] != END:
        raise ValueError("the record is not as long as its header says")
    return fields, rest[:size]


def _parsed(unpack: zstandard.ZstdDecompressor, address: str, header: bytes, packed: bytes | None):
    if packed is None:
        raise ValueError(f"payload {address} is missing")
    payload = unpack.decompress(packed)
    fields, block = parse_record(rebuild(header, payload))
    sha1 = hashlib.sha1(payload).hexdigest()
    stated = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if hashlib.sha256(payload).hexdigest() != address or stated != sha1:
        raise ValueError(f"payload {address} does not have its digest")
    kind = fields["WARC-Type"]
    http, _, body = block.partition(END)
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    if size != len(payload) or (kind == "response" and body != payload):
        raise ValueError(f"payload {address} is not the one of its record")
    return (
        _page_of(fields["WARC-Record-ID"]),
        fields.get("WARC-Target-URI"),
        size,
        sha1,
        kind,
        _page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None,
    )


def _page_of(name: str) -> int | None:
    page = name.split(":")[2]
    return None if page == "none" else int(page)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to a fresh archive in the shared folder and read it back."""
    path = new_run_dir(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path)
