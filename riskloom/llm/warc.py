"""Web archives (WARC 1.1, one gzip member a record) as chunked record tables.

Writing: a payload that several pages share is stored once, as the response of the smallest page id; the others are
revisits that refer to it. Each task writes archives of about ``ARCHIVE_BYTES`` and lists them; only listed files count, so
an archive of a task that was lost or run twice is never read.

Reading: an archive is a stream. A record becomes rows of a record identifier, a chunk number, at most ``CHUNK_BYTES`` of
payload and the digest of all payload so far, so that neither side ever holds a whole record, however large.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.session import Scratch, checked_broadcast

LEAST_SHARED = 100
CHUNK_BYTES = 256 << 10
ARCHIVE_BYTES = 64 << 20
DATE = "1970-01-01T00:00:00Z"
LEVEL = 1

#: Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
END = b"\r\n\r\n"

_NAMES = uuid.UUID("8c7d4f0e-2f0b-5a0e-9a55-3d0e6f3b1c11")
_MANIFEST = "file string, records long, bytes long"
CHUNKS = (
    "file string, record long, record_id string, record_type string, page_id long, refers_to_id string, "
    "payload_digest string, chunk int, at long, data binary, digest string, last boolean"
)


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id}:{digest}')}>"


def _open(path: str):
    system, place = fs.FileSystem.from_uri(path)
    return system, place


def _header(fields: list[tuple[str, object]]) -> bytes:
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in fields if v is not None]
    return b"\r\n".join(lines) + END


def _uri(url: str | None) -> str | None:
    """A URL that cannot break a header line."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


class _Archive:
    """One file being written."""

    def __init__(self, folder: str):
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
        system, place = _open(self.path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.stream, self.records, self.bytes = system.open_output_stream(place, compression=None), 0, 0

    def add(self, header: bytes, parts: list[memoryview | bytes]) -> None:
        """A record, compressed a chunk at a time."""
        packer = zlib.compressobj(LEVEL, wbits=31)
        for part in (header, *parts, END):
            for i in range(0, len(part), CHUNK_BYTES):
                self._put(packer.compress(part[i : i + CHUNK_BYTES]))
        self._put(packer.flush())
        self.records += 1

    def _put(self, data: bytes) -> None:
        self.bytes += len(data)
        self.stream.write(data)

    def close(self) -> tuple[str, int, int]:
        self.stream.close()
        return self.path, self.records, self.bytes


def _writer(folder: str, archive_bytes: int):
    def listed(archive: _Archive) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(("file", "records", "bytes"), archive.close()))])

    def run(batches):
        archive = None
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "digest", "first")]
            for page_id, url, html, digest, first in zip(*columns):
                page_id, digest, first = page_id.as_py(), digest.as_py(), first.as_py()
                payload = memoryview(html.as_buffer()) if html.is_valid else b""
                revisit = first is not None and first != page_id
                body = [HTTP_HEAD] if revisit else [HTTP_HEAD, payload]
                header = _header([
                    ("WARC-Type", "revisit" if revisit else "response"),
                    ("WARC-Record-ID", record_id(page_id, digest)),
                    ("WARC-Date", DATE),
                    ("WARC-Target-URI", _uri(url.as_py())),
                    ("WARC-Profile", REVISIT_PROFILE if revisit else None),
                    ("WARC-Refers-To", record_id(first, digest) if revisit else None),
                    ("WARC-Payload-Digest", f"sha256:{digest}"),
                    ("X-Page-ID", page_id),
                    ("Content-Type", "application/http; msgtype=response"),
                    ("Content-Length", sum(map(len, body))),
                ])
                archive = archive or _Archive(folder)
                archive.add(header, body)
                if archive.bytes >= archive_bytes:
                    yield listed(archive)
                    archive = None
        if archive:
            yield listed(archive)

    return run


def write_archives(pages: DataFrame, folder: str, scratch: Scratch, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives below ``folder``; the list ``(file, records, bytes)`` of them.

    Only digests, ids and lengths are grouped to find shared payloads. Where these are few they are broadcast, else the
    join moves the pages.
    """
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"))
    pages = pages.withColumn("digest", F.sha2("html", 256))
    shared = pages.where(F.octet_length("html") >= LEAST_SHARED).groupBy("digest")
    shared = shared.agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    shared = checked_broadcast(scratch.table(shared, "shared"))
    rows = pages.join(shared, "digest", "left").select("page_id", "url", "html", "digest", "first")
    return scratch.table(rows.mapInArrow(_writer(folder, archive_bytes), _MANIFEST), "manifest")


def _unpacked(path: str) -> Iterator[tuple[int, bytes]]:
    """Number of the record and the next bytes of it, at most a chunk at a time."""
    system, place = _open(path)
    with system.open_input_stream(place, compression=None, buffer_size=CHUNK_BYTES) as stream:
        record, unpacker, waiting = 0, zlib.decompressobj(wbits=31), b""
        while True:
            waiting = waiting or stream.read(CHUNK_BYTES)
            if not waiting:
                return
            yield record, unpacker.decompress(waiting, CHUNK_BYTES)
            waiting = unpacker.unconsumed_tail or unpacker.unused_data
            if unpacker.eof:
                record, unpacker = record + 1, zlib.decompressobj(wbits=31)


def read_records(path: str) -> Iterator[dict]:
    """The chunk rows of an archive."""
    number, row = -1, None
    for record, data in _unpacked(path):
        if record != number:
            number, head, row = record, b"", None
        if row is None:
            head += data
            fields_end = head.find(END)
            if fields_end < 0:
                continue
            fields = dict(line.split(": ", 1) for line in head[:fields_end].decode().split("\r\n")[1:])
            body, left = fields_end + len(END), int(fields["Content-Length"])
            payload = head.find(END, body)
            if payload < 0:
                continue
            payload += len(END)
            left -= payload - body
            data, digest = head[payload:], hashlib.sha256()
            page_id = fields.get("X-Page-ID")
            row = {
                "file": path,
                "record": record,
                "record_id": fields["WARC-Record-ID"],
                "record_type": fields["WARC-Type"],
                "page_id": None if page_id is None else int(page_id),
                "refers_to_id": fields.get("WARC-Refers-To"),
                "payload_digest": fields["WARC-Payload-Digest"].partition(":")[2],
            }
            chunk, at = 0, 0
            if not left:
                yield row | {"chunk": 0, "at": 0, "data": b"", "digest": digest.hexdigest(), "last": True}
        data = data[:left]
        if data:
            digest.update(data)
            left -= len(data)
            yield row | {"chunk": chunk, "at": at, "data": data, "digest": digest.copy().hexdigest(), "last": not left}
            chunk, at = chunk + 1, at + len(data)


_CHUNK_TYPE = pa.schema([
    ("file", pa.string()), ("record", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
    ("page_id", pa.int64()), ("refers_to_id", pa.string()), ("payload_digest", pa.string()), ("chunk", pa.int32()),
    ("at", pa.int64()), ("data", pa.binary()), ("digest", pa.string()), ("last", pa.bool_()),
])


def _reader(batches):
    for batch in batches:
        for path in batch.column("file").to_pylist():
            rows, held = [], 0
            for row in read_records(path):
                rows.append(row)
                held += len(row["data"])
                if held >= CHUNK_BYTES * 8 or len(rows) >= 1_000:
                    yield pa.RecordBatch.from_pylist(rows, _CHUNK_TYPE)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, _CHUNK_TYPE)


def read_archives(files: DataFrame) -> DataFrame:
    """The chunk rows of the archives listed in ``files(file, …)``; an archive is one task's stream."""
    names = files.select("file")
    n = max(1, min(names.count(), 10_000))
    return names.repartition(n, "file").mapInArrow(_reader, CHUNKS)


def round_trip(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages``, read the archives back, and return a row per record:
    ``(page_id, payload_bytes, payload_digest, record_type, refers_to, intact)``.

    Of records with equal payloads of at least ``LEAST_SHARED`` bytes that with the smallest page id is the response.
    Payload size and digest of a revisit are those of the response it refers to; ``intact`` says that the digest in its
    header and the one computed while reading agree.

    - null html: empty; empty and short payloads: responses; payloads of any length: streamed;
    - rows that repeat the smallest page id and its payload: all responses; null ids never are the smallest, so where
      others share the payload they revisit, else they are responses;
    - null url: no target URI; no rows: no rows; other columns are ignored.
    """
    spark = pages.sparkSession
    with Scratch(spark, "warc") as scratch:
        files = write_archives(pages, scratch.path("archives"), scratch, archive_bytes)
        last = read_archives(files).where("last")
        size = (F.col("at") + F.octet_length("data")).alias("bytes")
        read = scratch.table(
            last.select("record_id", "record_type", "page_id", "refers_to_id", "payload_digest", size, "digest"), "read"
        )
        originals = read.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id")).agg(
            F.min("page_id").alias("refers_to"), F.first("bytes").alias("full"), F.first("digest").alias("full_digest")
        )
        asked = read.where("refers_to_id is not null").select("refers_to_id").distinct()
        rows = read.join(originals.join(asked, "refers_to_id"), "refers_to_id", "left")
        own = F.col("record_type") == "response"
        digest = F.when(own, F.col("digest")).otherwise(F.col("full_digest"))
        return scratch.result(
            rows.select(
                "page_id",
                F.when(own, F.col("bytes")).otherwise(F.col("full")).alias("payload_bytes"),
                digest.alias("payload_digest"),
                "record_type",
                F.when(~own, F.col("refers_to")).alias("refers_to"),
                (digest == F.col("payload_digest")).alias("intact"),
            )
        )
