"""Token-id files of bit or byte planes.

Documents are range-partitioned and sorted by id; each partition becomes one shard of fixed-size id blocks. The
ids of a block are transposed into planes (all lowest bytes, all next bytes, ...; or single bits), which compress
far better than whole ids, and every plane is compressed with zstandard. A file holds one row per block:

    shard, chunk      block number within the shard
    first, n_ids      ids of the shard before the block, and in it (only a shard's last block is short)
    width, plane      bytes per id; "byte" or "bit"
    planes            the compressed planes, lowest first
    docs              the documents that have ids in the block: (seq, doc_id, start, n_tokens, skip, length)

The columns other than `planes` are the chunk index: a reader finds a document's blocks without touching ids.
The container is Parquet, so writing is atomic per task and works on any file system that Spark reaches.

Cases: a null text is an empty document (only the end id); a null doc_id comes first; rows with one doc_id are
ordered by their text; an empty table gives files without rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import LongType

from tallyworks.llm.digests import ids_crc32, joined_crc32
from tallyworks.llm.tokens import encoder

CHUNK_SCHEMA = ("shard int, chunk int, first long, n_ids int, width int, plane string, planes array<binary>, "
                "docs array<struct<seq:long,doc_id:long,start:long,n_tokens:long,skip:long,length:long>>")
_CHUNK_ARROW = pa.schema([
    ("shard", pa.int32()), ("chunk", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()),
    ("width", pa.int32()), ("plane", pa.string()), ("planes", pa.list_(pa.binary())),
    ("docs", pa.list_(pa.struct([(n, pa.int64()) for n in
                                 ("seq", "doc_id", "start", "n_tokens", "skip", "length")]))),
])
PART_SCHEMA = "shard int, seq long, doc_id long, start long, n_tokens long, skip long, length long, crc long"


def to_planes(ids: np.ndarray, width: int, plane: str, level: int = 3) -> list[bytes]:
    """Transpose the ids and compress each plane."""
    columns = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)[:, :width]
    if plane == "bit":
        rows = [np.packbits((columns[:, b] >> k) & 1) for b in range(width) for k in range(8)]
    elif plane == "byte":
        rows = [np.ascontiguousarray(columns[:, b]) for b in range(width)]
    else:
        raise ValueError(f"plane must be 'bit' or 'byte', not {plane!r}")
    packer = zstandard.ZstdCompressor(level=level)
    return [packer.compress(row.tobytes()) for row in rows]


def from_planes(planes: list[bytes], n_ids: int, width: int, plane: str) -> np.ndarray:
    """The ids of a block."""
    unpack = zstandard.ZstdDecompressor()
    raw = [np.frombuffer(unpack.decompress(p), np.uint8) for p in planes]
    columns = np.zeros((n_ids, 4), np.uint8)
    for k, row in enumerate(raw):
        if plane == "bit":
            columns[:, k // 8] |= np.unpackbits(row, count=n_ids) << np.uint8(k % 8)
        else:
            columns[:, k] = row
    return columns.reshape(-1).view("<u4")


class _Shard:
    """Cuts the ids of one partition into blocks; holds one block and the document at hand."""

    def __init__(self, shard: int, block_ids: int, width: int, plane: str):
        self.shard, self.block_ids, self.width, self.plane = shard, block_ids, width, plane
        self.chunk = self.total = self.seq = self.held = 0
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        skip, n, start = 0, len(ids), self.total
        while skip < n:
            take = min(n - skip, self.block_ids - self.held)
            self.parts.append(ids[skip:skip + take])
            self.docs.append((self.seq, doc_id, start, n, skip, take))
            self.held += take
            skip += take
            if self.held == self.block_ids:
                yield self.flush()
        self.total += n
        self.seq += 1

    def flush(self) -> dict:
        ids = np.concatenate(self.parts)
        names = ("seq", "doc_id", "start", "n_tokens", "skip", "length")
        row = {
            "shard": self.shard, "chunk": self.chunk, "first": self.chunk * self.block_ids, "n_ids": len(ids),
            "width": self.width, "plane": self.plane, "planes": to_planes(ids, self.width, self.plane),
            "docs": [dict(zip(names, d)) for d in self.docs],
        }
        self.chunk, self.held, self.parts, self.docs = self.chunk + 1, 0, [], []
        return row


def write_ids(docs: DataFrame, path: str, tokenizer: str, keep_white: bool, end_id: int, block_ids: int = 1 << 16,
              plane: str = "byte") -> None:
    """Encode `docs` (doc_id, text) and write their ids in ascending doc_id order."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer, keep_white)
        width = 2 if max(known.tokenizer.get_vocab_size(), end_id) < 1 << 16 else 4
        shard = _Shard(TaskContext.get().partitionId(), block_ids, width, plane)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for doc_id, ids in zip(names, known.texts(batch.column(1))):
                for row in shard.add(doc_id, np.concatenate([ids, end])):
                    yield pa.RecordBatch.from_pylist([row], _CHUNK_ARROW)
        if shard.held:
            yield pa.RecordBatch.from_pylist([shard.flush()], _CHUNK_ARROW)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # By id and a hash of the text, so that rows without an id, or of one id, are dealt out as well; not by the text, of
    # which the driver would get a sample.
    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    # The planes are compressed already.
    ordered.mapInArrow(encode, CHUNK_SCHEMA).write.option("compression", "none").parquet(path)


def read_parts(chunks: DataFrame) -> DataFrame:
    """The documents' parts in each block, decoded, as (shard, seq, doc_id, start, n_tokens, skip, length, crc)."""
    names = ("seq", "doc_id", "start", "n_tokens", "skip", "length")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes(row["planes"], row["n_ids"], row["width"], row["plane"])
                at, columns = 0, {n: [] for n in (*names, "crc")}
                for doc in row["docs"]:
                    for n in names:
                        columns[n].append(doc[n])
                    columns["crc"].append(ids_crc32(ids[at:at + doc["length"]]))
                    at += doc["length"]
                shard = pa.array([row["shard"]] * len(row["docs"]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [shard, *(pa.array(columns[n], pa.int64()) for n in (*names, "crc"))],
                    ["shard", *names, "crc"])

    return chunks.select("shard", "n_ids", "width", "plane", "planes", "docs").mapInArrow(decode, PART_SCHEMA)


def _joined(parts: list) -> int:
    crc = 0
    for part in sorted(parts):
        crc = joined_crc32(crc, part["crc"], 4 * part["length"])
    return crc


_whole_crc = F.udf(_joined, LongType())


def read_documents(chunks: DataFrame) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    A document's parts meet by (shard, seq), which no key makes hot; most documents have one part. The offset of a
    shard is the sum over the shards before it, of which there are as many as partitions.
    """
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (chunks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
             .select("shard", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("base")))
    whole = read_parts(chunks).groupBy("shard", "seq").agg(
        F.first("doc_id").alias("doc_id"), F.first("start").alias("start"), F.first("n_tokens").alias("n_tokens"),
        F.collect_list(F.struct("skip", "crc", "length")).alias("parts"))
    crc = F.when(F.size("parts") == 1, F.col("parts")[0]["crc"]).otherwise(_whole_crc("parts"))
    return whole.join(bases, "shard").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", crc.alias("ids_crc32"))


def read_ids(chunks: DataFrame) -> DataFrame:
    """The ids themselves, one row per block: shard, first, ids (array of long)."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = from_planes(row["planes"], row["n_ids"], row["width"], row["plane"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]], pa.int32()), pa.array([row["first"]], pa.int64()),
                     pa.array([ids.astype(np.int64)], pa.list_(pa.int64()))], ["shard", "first", "ids"])

    return (chunks.select("shard", "first", "n_ids", "width", "plane", "planes")
            .mapInArrow(decode, "shard int, first long, ids array<long>"))
