"""Id files and packing against the tokenizers library, text by text."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import edge
from tallyworks.llm import bitplanes, packing
from tallyworks.llm.digests import joined_crc32
from tallyworks.llm.staging import fresh_path, ship_package
from tallyworks.llm.tokens import encoder

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


def ids_of(path, text):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path,keep_white", [(WORD, False), (BYTE, True)])
def test_pieces_give_the_ids_of_whole_texts(path, keep_white):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    rng = random.Random(5)
    parts = ["a", "Zé", "ß", "12", "!", "'s", ",", ".", " ", "   ", "\n", "\t", "\x85", "　", "\x1c", "́", "Σ",
             "日本", "<|endoftext|>", "\r\n", "\xa0", "١", "don't,"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + [None, "", "a, b. c"]
    got = [ids.tolist() for ids in encoder(path, keep_white).texts(pa.array(texts))]
    assert got == [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("plane", ["bit", "byte"])
@pytest.mark.parametrize("width", [2, 4])
def test_planes_round_trip(plane, width):
    ids = np.random.default_rng(1).integers(0, 1 << (8 * width - 1), 1003).astype(np.uint32)
    planes = bitplanes.to_planes(ids, width, plane)
    assert len(planes) == width * (8 if plane == "bit" else 1)
    assert (bitplanes.from_planes(planes, len(ids), width, plane) == ids).all()


def test_unknown_plane_is_refused():
    with pytest.raises(ValueError):
        bitplanes.to_planes(np.zeros(3, np.uint32), 2, "nibble")


def test_crc_of_parts():
    a, b = b"some bytes", b"and more of them" * 9
    assert joined_crc32(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert joined_crc32(zlib.crc32(a), zlib.crc32(b""), 0) == zlib.crc32(a)


def test_bit_plane_files_of_edge_rows(spark):
    ship_package(spark)
    path = fresh_path(spark, "test-planes")
    bitplanes.write_ids(edge.documents(spark), path, WORD, False, end_id=1, block_ids=500, plane="bit")
    chunks = spark.read.parquet(path)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in bitplanes.read_documents(chunks).collect()),
                 key=lambda r: r[1])
    want, start = [], 0
    for doc_id, text in sorted(edge.TEXTS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(ids_of(WORD, text) + [1], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    assert got == want
    whole = {(r.shard, r.first): r.ids for r in bitplanes.read_ids(chunks).collect()}
    assert sum(map(len, whole.values())) == start
    assert all(len(v) == 500 for (s, f), v in whole.items() if (s, f + 500) in whole)


def test_rows_without_an_id_are_spread_over_the_shards(spark):
    ship_package(spark)
    rows = [(None if k % 3 == 0 else k, f"text number {k * 7919 % 3000}") for k in range(3000)]
    path = fresh_path(spark, "planes")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        bitplanes.write_ids(spark.createDataFrame(rows, "doc_id long, text string"), path, WORD, False, end_id=1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    chunks = spark.read.schema(bitplanes.CHUNK_SCHEMA).parquet(path)
    shards = Counter(r.shard for r in bitplanes.read_parts(chunks).collect())
    assert sum(shards.values()) == 3000 and max(shards.values()) < 800
    got = bitplanes.read_documents(chunks).collect()
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == [None] * 1000 + [k for k in range(3000) if k % 3]


def test_bit_plane_files_of_nothing(spark):
    ship_package(spark)
    path = fresh_path(spark, "test-planes")
    bitplanes.write_ids(edge.no_documents(spark), path, WORD, False, end_id=1)
    assert bitplanes.read_documents(spark.read.schema(bitplanes.CHUNK_SCHEMA).parquet(path)).collect() == []


def check_pieces(pieces, docs, sequence):
    """Every id of every row once, sequences gapless and full but for the last one of a run of windows."""
    by_id, by_sequence, rows = defaultdict(list), defaultdict(list), Counter()
    for p in pieces:
        by_id[p.doc_id].append(p)
        by_sequence[p.sequence_id].append((p.offset, p.length))
    tokens = defaultdict(list)
    for doc_id, text in docs:
        tokens[doc_id].append(np.array(ids_of(BYTE, text) + [0], "<u4"))
        rows[doc_id] += 1
    assert set(by_id) == set(tokens)
    for doc_id, own in by_id.items():
        if rows[doc_id] > 1:
            assert sum(p.length for p in own) == sum(map(len, tokens[doc_id]))
            continue
        at, ids = 0, tokens[doc_id][0]
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length])
            at += p.length
        assert at == len(ids)
    short = 0
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= sequence
        short += at < sequence
    return short


def test_packing_of_edge_rows(spark):
    ship_package(spark)
    pieces = packing.pack(edge.documents(spark), BYTE, True, 0, sequence=64, sequences_per_window=4).collect()
    assert check_pieces(pieces, edge.TEXTS, 64) <= 1
    assert packing.pack(edge.no_documents(spark), BYTE, True, 0).collect() == []


def test_packing_mixture(spark):
    ship_package(spark)
    texts = [(k, edge.words(k, 90)) for k in range(40)]
    rows = [(i, t, f"s{i % 3}") for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    targets = {"s0": 0.5, "s1": 0.3, "s2": 0.2}
    pieces = packing.pack(docs, BYTE, True, 0, sequence=128, sequences_per_window=4, targets=targets).collect()
    assert check_pieces(pieces, texts, 128) <= 1
    windows = defaultdict(Counter)
    for p in pieces:
        windows[p.window][p.source] += p.length
    # The first queue to run out is s0; until then every window holds the target shares to within a token or two.
    total = Counter()
    for c in windows.values():
        total += c
    full = int(total["s0"] // (512 * 0.5))
    for k in range(full - 1):
        for s, share in targets.items():
            assert abs(windows[k][s] - 512 * share) <= 2, (k, windows[k])


def test_schedule_places_every_token_once():
    rng = random.Random(9)
    for trial in range(60):
        totals = {f"q{k}": rng.choice((0, 1, 3, 50, 700, 3000)) for k in range(rng.randint(1, 9))}
        targets = None if trial % 2 else {s: rng.choice((0, 0.1, 1, 5)) for s in totals}
        window = rng.choice((16, 64, 1000))
        phases = packing.schedule(totals, window, targets)
        seen = Counter()
        for source, n in totals.items():
            if n:
                places = packing.Places(phases, source, window)
                at = 0
                while at < n:
                    size = min(n - at, rng.randint(1, 400))
                    for k, where, length in places.runs(at, size):
                        assert 0 <= where and where + length <= window
                        seen.update((k, where + j) for j in range(length))
                    at += size
        assert len(seen) == sum(totals.values()) and set(seen.values()) <= {1}


def test_schedule_holds_equal_targets_with_many_sources():
    """5,000 sources with equal targets: full windows hold 13.1 tokens of each to within two, until one runs out."""
    rng = random.Random(3)
    totals = {f"q{k}": rng.randint(200, 2000) for k in range(5000)}
    window = 1 << 16
    tiers = packing.schedule(totals, window, dict.fromkeys(totals, 1))
    full = min(totals.values()) * len(totals) // window
    for source in rng.sample(sorted(totals), 300):
        taken = Counter()
        for k, _, length in packing.Places(tiers, source, window).runs(0, totals[source]):
            taken[k] += length
        assert sum(taken.values()) == totals[source]
        assert all(abs(taken[k] - window / 5000) < 2 for k in range(full))


def test_schedule_goes_on_in_proportion_when_a_queue_runs_out():
    totals, window = {"a": 1000, "b": 4000, "c": 9000, "late": 700}, 100
    tiers = packing.schedule(totals, window, {"a": 2, "b": 1, "c": 2})
    taken = defaultdict(Counter)
    for source, n in totals.items():
        for k, _, length in packing.Places(tiers, source, window).runs(0, n):
            taken[k][source] += length
    assert all(sum(c.values()) == window for c in taken.values())
    assert all(abs(taken[k]["a"] - 40) < 2 and abs(taken[k]["b"] - 20) < 2 for k in range(25))
    # Then b and c share the windows one to two, c alone after both, and the source without a target at the end.
    assert all(abs(taken[k]["b"] - 100 / 3) < 2 and not taken[k]["late"] for k in range(26, 130))
    assert sorted(k for k in taken if taken[k]["late"]) == list(range(140, 147))


def test_small_sources_share_a_queue(spark):
    """Sources below two tokens a window are packed whole all the same, null and empty ones among them."""
    ship_package(spark)
    texts = [(k, edge.words(k, 30)) for k in range(200)]
    rows = [(i, t, None if i % 50 == 0 else "" if i % 50 == 1 else f"s{i % 150}") for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(6)
    for targets in (packing.EQUAL, {"s5": 0.9, "s6": 0.1}, None):
        pieces = packing.pack(docs, BYTE, True, 0, sequence=32, sequences_per_window=4, targets=targets).collect()
        assert check_pieces(pieces, texts, 32) <= 1
        assert len({p.sequence_id for p in pieces}) == -(-sum(p.length for p in pieces) // 32)
