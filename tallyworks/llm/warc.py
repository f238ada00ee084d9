"""WARC archives written and read in chunks.

A payload goes through the compressor and the digest piece by piece, and comes back as rows of a chunked record
table: (record, chunk number, bytes, running byte count, and the digest with the last chunk). Neither side
builds a whole record. Records are gzip members of their own, so an archive is an ordinary .warc.gz.

Each task writes archives of about `roll_bytes` under names of their own and reports them; only reported files are
read, so what a lost or repeated task leaves behind does not count. Files are opened with pyarrow's file systems
under the shared folder.

Of records with equal payloads of at least `min_bytes` bytes, the one with the smallest page_id is a response
and the others are revisits: headers with the payload's digest and length, but no payload.

Cases: a null payload is empty; a null url is an empty target; rows with one page_id and payload are all of the
type of the first; a null page_id is larger than any other and never referred to; an empty table gives no rows; other
columns are ignored. Line breaks in an url are percent-encoded.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyworks.llm.staging import staged

CHUNK_BYTES = 1 << 20
MANIFEST_SCHEMA = "file string, records long, bytes long"
CHUNK_SCHEMA = ("page_id long, url string, record_type string, refers_to long, chunk long, last boolean, "
                "bytes_so_far long, payload_digest string, data binary")
_CHUNK_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
    ("chunk", pa.int64()), ("last", pa.bool_()), ("bytes_so_far", pa.int64()), ("payload_digest", pa.string()),
    ("data", pa.binary()),
])


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def typed_records(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, sha1, refers_to): `refers_to` is null for responses.

    Only digests of several records are joined back, so a payload with very many copies is one row there.
    """
    rows = pages.select(
        F.col("page_id").cast("long"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    long_enough = rows.where(F.octet_length("payload") >= min_bytes)
    copies = staged(long_enough.groupBy("sha1").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
                    .where("n > 1").select("sha1", "first_id"), "copies")
    return rows.join(copies, "sha1", "left").select(
        "page_id", "url", "payload", "sha1",
        F.when((F.octet_length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("first_id")),
               F.col("first_id")).alias("refers_to"))


def _head(page_id: int | None, url: str, size: int, sha1: str, refers_to: int | None, date: str) -> bytes:
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n").encode()
    revisit = refers_to is not None
    target = url.replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{base32_sha1(bytes.fromhex(sha1))}",
    ]
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(http) + (0 if revisit else size)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http


class _Archives:
    """Archive files of one task; a new one after `roll_bytes`."""

    def __init__(self, folder: str, roll_bytes: int, level: int):
        self.files, self.root = fs.FileSystem.from_uri(folder)
        self.roll_bytes, self.level, self.out = roll_bytes, level, None

    def open(self) -> None:
        self.name = f"{uuid.uuid4().hex}.warc.gz"
        self.files.create_dir(self.root, recursive=True)
        self.out = self.files.open_output_stream(f"{self.root}/{self.name}", compression=None)
        self.records = self.bytes = 0

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        self.out = None
        return self.name, self.records, self.bytes

    def add(self, head: bytes, payload: memoryview) -> Iterator[tuple[str, int, int]]:
        if self.out is None:
            self.open()
        pack = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        parts = [head, *(payload[k:k + CHUNK_BYTES] for k in range(0, len(payload), CHUNK_BYTES)), b"\r\n\r\n"]
        for part in parts:
            self._put(pack.compress(part))
        self._put(pack.flush())
        self.records += 1
        if self.bytes >= self.roll_bytes:
            yield self.close()

    def _put(self, data: bytes) -> None:
        if data:
            self.out.write(data)
            self.bytes += len(data)


def write_warc(records: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", roll_bytes: int = 64 << 20,
               level: int = 1) -> DataFrame:
    """Write `typed_records` as archives under `folder`; returns their manifest (file, records, bytes)."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives, done = _Archives(folder, roll_bytes, level), []
        for batch in batches:
            page_ids, urls, _, sha1s, refers = (batch.column(k) for k in range(5))
            for page_id, url, payload, sha1, refers_to in zip(
                    page_ids.to_pylist(), urls.to_pylist(), batch.column(2), sha1s.to_pylist(), refers.to_pylist()):
                data = memoryview(payload.as_buffer())
                head = _head(page_id, url, len(data), sha1, refers_to, date)
                done += archives.add(head, data if refers_to is None else data[:0])
        if archives.out is not None:
            done.append(archives.close())
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "records", "bytes"), d)) for d in done])

    return staged(records.select("page_id", "url", "payload", "sha1", "refers_to")
                  .mapInArrow(write, MANIFEST_SCHEMA), "manifest")


class _Member:
    """Decompressed bytes of one gzip member after another, a bounded amount at a time."""

    def __init__(self, source):
        self.source, self.raw, self.held = source, b"", b""

    def next_member(self) -> bool:
        self.raw = self.raw or self.source.read(CHUNK_BYTES)
        self.unpack, self.held = zlib.decompressobj(31), b""
        return bool(self.raw)

    def more(self) -> bytes:
        """Some more bytes of the member; empty at its end."""
        while not self.unpack.eof:
            if not self.raw:
                self.raw = self.source.read(CHUNK_BYTES)
                if not self.raw:
                    raise ValueError("archive ends within a record")
            out = self.unpack.decompress(self.raw, CHUNK_BYTES)
            self.raw = self.unpack.unconsumed_tail or self.unpack.unused_data
            if out:
                return out
        return b""

    def head(self) -> dict[str, str]:
        """Header lines up to the empty line, names in lower case."""
        while b"\r\n\r\n" not in self.held:
            more = self.more()
            if not more:
                raise ValueError("record without an end of its header")
            self.held += more
        head, _, self.held = self.held.partition(b"\r\n\r\n")
        pairs = (line.partition(":") for line in head.decode("utf-8").split("\r\n")[1:])
        return {name.strip().lower(): value.strip() for name, _, value in pairs}

    def body(self, size: int) -> Iterator[bytes]:
        """`size` bytes in chunks."""
        while size:
            part = self.held[:size] or self.more()[:size]
            if not part:
                raise ValueError("record is shorter than its Content-Length")
            self.held = b""
            size -= len(part)
            yield part

    def skip(self) -> None:
        while self.more():
            pass


def _page(urn: str) -> int | None:
    text = urn.strip("<>").removeprefix("urn:page:")
    return int(text) if text else None


def _record_chunks(member: _Member, with_data: bool) -> Iterator[dict]:
    head = member.head()
    http = member.head()
    row = {"page_id": _page(head["warc-record-id"]), "url": head.get("warc-target-uri", ""),
           "record_type": head["warc-type"],
           "refers_to": _page(head["warc-refers-to"]) if "warc-refers-to" in head else None}
    size, count, total = int(http["content-length"]), 0, 0
    if row["record_type"] == "revisit":
        stated = head["warc-payload-digest"].removeprefix("sha1:")
        yield row | {"chunk": 0, "last": True, "bytes_so_far": size, "payload_digest": stated, "data": None}
    else:
        digest = hashlib.sha1()
        for part in member.body(size):
            digest.update(part)
            total += len(part)
            last = total == size
            yield row | {"chunk": count, "last": last, "bytes_so_far": total,
                         "payload_digest": base32_sha1(digest.digest()) if last else None,
                         "data": part if with_data else None}
            count += 1
        if size == 0:
            yield row | {"chunk": 0, "last": True, "bytes_so_far": 0,
                         "payload_digest": base32_sha1(digest.digest()), "data": b"" if with_data else None}
    member.skip()


def read_chunks(manifest: DataFrame, folder: str, with_data: bool = True) -> DataFrame:
    """The chunked record table of the archives in `manifest`, one file per task."""
    names = manifest.select("file")
    files = max(1, names.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with system.open_input_stream(f"{root}/{name}", compression=None) as source:
                    member, rows, held = _Member(source), [], 0
                    while member.next_member():
                        for row in _record_chunks(member, with_data):
                            rows.append(row)
                            held += len(row["data"] or b"") + 64
                            if held > 4 * CHUNK_BYTES:
                                yield pa.RecordBatch.from_pylist(rows, _CHUNK_ARROW)
                                rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, _CHUNK_ARROW)

    return names.repartition(files, "file").mapInArrow(read, CHUNK_SCHEMA)
