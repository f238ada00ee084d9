"""WARC archives: exact round trip, revisits, chunks of oversized payloads."""

import base64
import gzip
import hashlib
import random

import pytest
from pyarrow import fs

from tallyworks.llm import warc
from tallyworks.llm.staging import fresh_path, ship_package

SCHEMA = "page_id long, url string, html string, sha1 string, refers_to string, chunk string, first_id string"


def sha1(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(2)
    large = "".join(rng.choice("abcdefghij<>é") for _ in range(1_500_000))
    return [(1, "http://a/1", "<p>x</p>"), (2, None, None), (3, "http://a/3\r\nX: y", "<p>x</p>"), (4, "u", ""),
            (5, "http://big", large), (6, "u", "WARC/1.1\r\n\r\ntext\r\n\r\n"), (None, "u", "<p>x</p>"),
            (7, "u", "only once é"), (7, "u", "only once é")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "t", "c", "f") for r in rows], SCHEMA)


def expected(pages, min_bytes=0):
    first = {}
    for page_id, _, html in pages:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, _, html in pages:
        text = html or ""
        revisit = len(text.encode()) >= min_bytes and first.get(text) != page_id
        out.append((page_id, len(text.encode()), sha1(html), "revisit" if revisit else "response",
                    first[text] if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 9])
def test_round_trip(spark, pages, min_bytes):
    ship_package(spark)
    folder = fresh_path(spark, "test-warc")
    records = warc.typed_records(frame(spark, pages).repartition(3), min_bytes)
    manifest = warc.write_warc(records, folder, roll_bytes=200_000)
    rows = warc.read_chunks(manifest, folder).collect()
    got = sorted(((r.page_id, r.bytes_so_far, r.payload_digest, r.record_type, r.refers_to)
                  for r in rows if r.last), key=str)
    assert got == expected(pages, min_bytes)
    by_page = {p[0]: p[2] or "" for p in pages}
    for page_id in (1, 5, 6):
        own = sorted((r for r in rows if r.page_id == page_id), key=lambda r: r.chunk)
        if own[0].record_type == "response":
            assert b"".join(r.data for r in own).decode() == by_page[page_id]
            assert max(len(r.data) for r in own) <= warc.CHUNK_BYTES
            assert [r.payload_digest is None for r in own] == [not r.last for r in own]
    assert len([r for r in rows if r.page_id == 5]) > 1


def test_archives_are_ordinary_gzip_members(spark, pages):
    ship_package(spark)
    folder = fresh_path(spark, "test-warc")
    manifest = warc.write_warc(warc.typed_records(frame(spark, pages)), folder)
    files, root = fs.FileSystem.from_uri(folder)
    text = b"".join(gzip.decompress(files.open_input_stream(f"{root}/{r.file}", compression=None).read())
                    for r in manifest.collect())
    assert text.count(b"WARC-Type: ") == len(pages)
    assert b"X: y\r\n" not in text.replace(b"%0D%0AX: y\r\n", b"")


def test_unreported_files_do_not_count(spark, pages):
    ship_package(spark)
    folder = fresh_path(spark, "test-warc")
    manifest = warc.write_warc(warc.typed_records(frame(spark, pages)), folder)
    files, root = fs.FileSystem.from_uri(folder)
    with files.open_output_stream(f"{root}/left-behind.warc.gz", compression=None) as out:
        out.write(b"half a record")
    assert warc.read_chunks(manifest, folder).where("last").count() == len(pages)


def test_empty_table(spark):
    ship_package(spark)
    folder = fresh_path(spark, "test-warc")
    manifest = warc.write_warc(warc.typed_records(frame(spark, [])), folder)
    assert warc.read_chunks(manifest, folder).collect() == []
