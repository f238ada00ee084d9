"""Seeds and alignment against a plain alignment of every text with every item."""

import random
import re

import numpy as np

import edge
from tallyworks.llm import decontamination as dc
from tallyworks.llm.staging import ship_package

ITEMS = [(k, edge.words(100 + k, 30)) for k in range(6)] + [(6, "too short here"), (7, None), (8, edge.words(100, 30))]


def smith_waterman(a, b):
    grid, best = [[0.0] * (len(a) + 1) for _ in range(len(b) + 1)], 0.0
    for i, y in enumerate(b, 1):
        for j, x in enumerate(a, 1):
            grid[i][j] = max(0.0, grid[i - 1][j - 1] + (1 if x == y else -dc.MISS), grid[i - 1][j] - dc.GAP,
                             grid[i][j - 1] - dc.GAP)
            best = max(best, grid[i][j])
    return best


def split(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").translate(
        str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def edited(text, share, seed):
    rng, out = random.Random(seed), []
    for w in text.split():
        r = rng.random()
        if r < share / 3:
            continue
        out.append(f"new{rng.randint(0, 99)}" if r < 2 * share / 3 else w)
        if share * 2 / 3 <= r < share:
            out.append("more")
    return " ".join(out)


def test_alignment_equals_the_plain_recurrence():
    rng = random.Random(4)
    for _ in range(150):
        a = [rng.randint(0, 5) for _ in range(rng.randint(1, 25))]
        b = [rng.randint(0, 5) for _ in range(rng.randint(1, 12))]
        score, first, end = dc.align(np.array(a, np.uint64), np.array(b, np.uint64))
        assert abs(score - smith_waterman(a, b)) < 1e-9
        assert score == 0 or abs(smith_waterman(a[first:end], b) - score) < 1e-9


def test_finds_copies_and_edits_and_leaves_clean_texts(spark):
    ship_package(spark)
    texts = [(k, edge.words(1500 + k, 60)) for k in range(20)]
    texts += [(100 + k, f"{edge.words(700 + k, 40)} {ITEMS[k][1].upper()} {edge.words(800 + k, 50)}") for k in range(5)]
    texts += [(200 + k, f"{edge.words(900 + k, 40)}. {edited(ITEMS[k][1], 0.2, k)}, {edge.words(950 + k, 9)}")
              for k in range(5)]
    texts += [(300, " | ".join([ITEMS[3][1], edge.words(3, 200), ITEMS[3][1]]))] * 2
    docs = spark.createDataFrame([(*t, "x", 1) for t in texts + edge.TEXTS], "doc_id long, text string, gram string, row int")
    items = spark.createDataFrame([(*t, "b") for t in ITEMS], "item_id long, text string, item_words string")
    found = dc.find_leaks(docs, items).collect()
    pairs = sorted((r.doc_id, r.item_id) for r in found)
    want = []
    for doc_id, text in texts + edge.TEXTS:
        for item_id, item in ITEMS:
            if len(split(item)) >= dc.NGRAM and len(split(text)) < 2000 and \
                    smith_waterman(split(text), split(item)) >= dc.MIN_SCORE * len(split(item)):
                want.append((doc_id, item_id))
    assert pairs == sorted(want)
    assert {(100 + k, k) for k in range(5)} | {(200 + k, k) for k in range(5)} <= set(pairs)
    assert [r.places for r in found if r.doc_id == 300] == [2, 2]
    clean = {r.doc_id for r in dc.drop_leaks(docs, dc.find_leaks(docs, items)).collect()}
    assert clean == {i for i, _ in texts + edge.TEXTS} - {d for d, _ in want}


def test_a_passage_that_most_texts_hold_is_still_found(spark):
    ship_package(spark)
    docs = spark.createDataFrame([(k, f"{edge.words(2000 + k, 30)} {ITEMS[0][1]}") for k in range(200)], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:6], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in dc.find_leaks(docs, items).collect()} == {(k, 0) for k in range(200)}


def test_an_edited_copy_in_many_rows_is_found_in_each(spark):
    ship_package(spark)
    item = edge.words(60, 24)
    copy = " ".join(f"new{k}" if k % 6 == 5 else w for k, w in enumerate(item.split()))
    items = spark.createDataFrame([(0, item)], "item_id long, text string")
    assert smith_waterman(split(copy), split(item)) >= dc.MIN_SCORE * len(split(item))
    for n in (9, 200, 2000):
        docs = spark.createDataFrame([(k, f"{copy} {edge.words(4000 + k, 20)}") for k in range(n)] +
                                     [(n + k, edge.words(9000 + k, 40)) for k in range(9)], "doc_id long, text string")
        assert sorted(r.doc_id for r in dc.find_leaks(docs, items).collect()) == list(range(n))


def test_copies_without_untouched_runs_are_found_like_by_plain_alignment(spark):
    ship_package(spark)
    rng, items, texts = random.Random(8), [], []
    for size in (15, 17, 20):
        for share in (0.2, 0.3, 0.4):
            for seed in range(20):
                item = " ".join(edge.words(rng.randint(0, 10 ** 9), size).split())
                items.append((len(items), item))
                texts.append((len(texts), f"{edge.words(seed, 12)} {edited(item, share, seed)} {edge.words(seed + 50, 12)}"))
    # Every 4th word replaced, and another word behind each word.
    item = edge.words(77, 20)
    items += [(1000, item), (1001, edge.words(78, 20))]
    texts += [(1000, " ".join("new" if k % 4 == 3 else w for k, w in enumerate(item.split()))),
              (1001, " ".join(f"{w} more" for w in edge.words(78, 20).split()))]
    want = {(d, i) for d, t in texts for i, x in items if d == i and smith_waterman(split(t), split(x)) >= dc.MIN_SCORE * len(split(x))}
    found = dc.find_leaks(spark.createDataFrame(texts, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(1000, 1000), (1001, 1001)} <= want
    assert want == {(r.doc_id, r.item_id) for r in found if r.doc_id == r.item_id}


def test_items_of_few_words_are_found_word_for_word(spark):
    ship_package(spark)
    items = [(0, "Zebra"), (1, "blue Zebra"), (2, "a blue zebra"), (3, "a blue zebra"), (4, "..."), (5, edge.words(5, 12)),
             (6, "one two three four")]
    texts = [(1, "see a blue zebra, A Blue Zebra!"), (2, "blue zebras"), (3, "zebra zebra"), (4, "a blue"), (5, None), (6, ""),
             (7, "zebra"), (8, "a zebra blue"), (9, "one two three and more")]
    found = dc.find_leaks(spark.createDataFrame(texts, "doc_id long, text string"),
                          spark.createDataFrame(items, "item_id long, text string")).collect()
    few = {i: split(t) for i, t in items if 0 < len(split(t)) < dc.NGRAM}
    want = set()
    for d, t in texts:
        for i, x in few.items():
            w, places, at, first = split(t), 0, 0, None
            while at + len(x) <= len(w):
                if w[at:at + len(x)] == x:
                    first = at if first is None else first
                    places, at = places + 1, at + len(x)
                else:
                    at += 1
            if places:
                want.add((d, i, 1.0, places, first, first + len(x)))
    assert {tuple(r)[:6] for r in found if r.item_id in few} == want and len(want) == 7
    # From NGRAM words on, an edited copy is found too.
    assert [(r.doc_id, r.score) for r in found if r.item_id == 6] == [(9, 0.75)]


def test_clean_rows_that_share_the_id_of_a_leak_stay(spark):
    ship_package(spark)
    leak, clean = f"{edge.words(41, 20)} {ITEMS[1][1]}", [edge.words(42 + k, 50) for k in range(4)]
    docs = spark.createDataFrame([(None, leak), (None, clean[0]), (None, None), (5, leak), (5, clean[1]), (6, clean[2])],
                                 "doc_id long, text string")
    items = spark.createDataFrame(ITEMS[:6], "item_id long, text string")
    kept = dc.drop_leaks(docs, dc.find_leaks(docs, items)).collect()
    assert sorted(map(str, kept)) == sorted(map(str, docs.where(~docs.text.eqNullSafe(leak)).collect()))


def test_empty_tables(spark):
    ship_package(spark)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert dc.find_leaks(edge.no_documents(spark), items).collect() == []
    assert dc.find_leaks(edge.documents(spark), items.limit(0)).collect() == []
