"""Trie-shared counts against a plain dynamic program per word."""

import math
import random
import re
import time

import public_tokenizers
import pyarrow as pa

import edge
from tallyworks.llm import unigram
from tallyworks.llm.staging import ship_package
from tallyworks.llm.textgrid import text_blocks

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def brute(word: bytes, scores, longest, fallback):
    text, best, count = unigram.MARK + word, [0.0], [0]
    for end in range(1, len(unigram.MARK + word) + 1):
        top, tokens = -math.inf, 0
        for size in range(1, min(end, longest) + 1):
            gain = scores.get(text[end - size:end], fallback if size == 1 else None)
            if gain is not None and best[end - size] + gain > top:
                top, tokens = best[end - size] + gain, count[end - size] + 1
        best.append(top)
        count.append(tokens)
    return count[-1]


def counts(text, scores):
    longest, fallback = max(map(len, scores)), min(scores.values()) - 10
    words = [w for w in re.split(rb"[\x20\x09-\x0D]+", (text or "").encode()) if w]
    return len(words), sum(brute(w, scores, longest, fallback) for w in words)


def test_small_vocabulary_and_odd_bytes():
    scores = {"▁".encode(): -3.0, "▁a".encode(): -2.0, b"a": -2.5, b"ab": -3.0, b"abab": -4.5, b"b": -2.5, "é".encode(): -4.0}
    rng = random.Random(1)
    texts = ["".join(rng.choice("aabb\0 cé日\n") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += [None, "", "a\0 a a\0b a\0\0", "ab" * 2000]
    model, got = unigram.UnigramCounter(scores, limit=300), []
    for _, _, data, offsets in text_blocks(pa.array(texts), block_bytes=900):
        got += zip(*(x.tolist() for x in model.count(data, offsets)))
    assert got == [counts(t, scores) for t in texts]


def test_long_words_equal_the_plain_program_and_take_little_time(monkeypatch):
    rng = random.Random(2)
    scores = unigram.zipf_scores(MODEL)
    model = unigram.UnigramCounter(scores)
    texts = ["".join(rng.choice(("an", "be", "ing", "é", "x", "日")) for _ in range(n)) for n in (150, 260, 400, 3000)]
    texts += [f"a {texts[3]} b {texts[2]}", "z" * 513]
    for stretch in (unigram.STRETCH, 100):
        monkeypatch.setattr(unigram, "STRETCH", stretch)
        model._reset()
        got = [tuple(x.tolist()) for _, _, d, o in text_blocks(pa.array(texts)) for x in model.count(d, o)]
        assert list(zip(*got)) == [counts(t, scores) for t in texts]
    monkeypatch.undo()
    word, started = "".join(rng.choice("abcdefgh") for _ in range(200_000)), time.perf_counter()
    (_, _, data, offsets), = text_blocks(pa.array([word]))
    tokens = model.count(data, offsets)[1].tolist()
    assert time.perf_counter() - started < 4
    assert tokens == [counts(word, scores)[1]]


def test_query_form(spark):
    ship_package(spark)
    scores = unigram.zipf_scores(MODEL)
    texts = [(i, t if t is None or len(t) < 5000 else t[:3000]) for i, t in edge.TEXTS]
    got = sorted((tuple(r) for r in unigram.token_counts(edge.documents(spark, texts), MODEL).collect()), key=str)
    assert got == sorted(((i, *counts(t, scores)) for i, t in texts), key=str)
    assert unigram.token_counts(edge.no_documents(spark), MODEL).collect() == []
