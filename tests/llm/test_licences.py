"""Licence scan against exact counting and a plain search for verified spans."""

import random
import re

import edge
from tallyworks.llm import license_scan as ls
from tallyworks.llm.license_texts import PHRASES, TEMPLATES

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NAMED = {name: text for name, _, text in TEMPLATES}


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def base(text):
    w, places, labels = split(text), [], []
    for phrase, label in PHRASES:
        parts = phrase.split()
        here = [k for k in range(len(w)) if w[k:k + len(parts)] == parts]
        places += here
        labels += [label] if here else []
    return len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = edge.TEXTS + [
    (20, f"{edge.words(5, 90)}\n{NAMED['mit-text']}\n{edge.words(6, 20)}"),
    (21, NAMED["apache-header"].replace("in compliance with", "in accordance with").replace("Unless", "If not")),
    (22, "Licensed under CC BY-NC 4.0. All Rights Reserved!"), (22, "Licensed under CC BY-NC 4.0. All Rights Reserved!"),
    (23, "cc by cc by ÉCC BY general public licence ALL RIGHTS reserved all rights reserved"),
    (24, " ".join(["Released under the MIT License."] * 50)),
    (25, "the terms of the license are under the bed"), (26, NAMED["bsd-text"][: len(NAMED["bsd-text"]) // 4]),
]


def test_base_counts_and_labels(spark):
    got = ls.scan(edge.documents(spark, TEXTS)).collect()
    key = lambda r: (str(r[0]), str(r[1:]))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == \
        sorted(((i, *base(t)) for i, t in TEXTS), key=key)
    labels = {r.doc_id: r.labels for r in got}
    assert labels[20] == "mit" and labels[21] == "apache-2.0" and labels[24] == "mit"
    assert labels[22] == "cc-by,cc-by-nc-4.0,reserved"
    assert labels[23] == "cc-by,reserved"
    assert labels[25] == labels[26] == labels[5] == ""
    assert all(0 <= r.score <= 1 and (r.score > 0) == (r.labels != "") for r in got)
    assert next(r.score for r in got if r.doc_id == 20) == 1.0


def test_no_python_on_the_main_path(spark):
    plan = ls.scan(edge.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_spans(spark):
    text = NAMED["isc-text"]
    docs = spark.createDataFrame([(7, f"{edge.words(1, 11)} {text} {edge.words(2, 5)}"),
                                  (8, text.replace("any purpose", "every good purpose"))], "row long, text string")
    spans = {s.row: s for s in ls.find_spans(docs, ls.template_table(spark)).collect() if s.label == "isc"}
    assert (spans[7].first_word, spans[7].end_word, spans[7].similarity) == (11, 11 + len(split(text)), 1.0)
    assert spans[8].first_word == 0 and 0.8 <= spans[8].similarity < 1


def test_a_stray_run_beside_an_exact_notice_does_not_hide_it(spark):
    templates = spark.createDataFrame([("short", "mit", split("Released under the MIT License"), "released under the mit license")],
                                      "template string, label string, t_words array<string>, t_text string")
    docs = spark.createDataFrame([(1, "Released under the MIT License. The MIT License permits anything"),
                                  (2, "The MIT License: released under the MIT License"),
                                  (3, "the MIT License is what it says")], "row long, text string")
    spans = {s.row: s for s in ls.find_spans(docs, templates).collect()}
    assert set(spans) == {1, 2}
    assert [(spans[k].first_word, spans[k].end_word, spans[k].similarity) for k in (1, 2)] == [(0, 5, 1.0), (3, 8, 1.0)]


def plain_levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def plain_spans(words, templates):
    """Verified spans of one text by the definition: votes, bands, parts, the nearest of a band and of a place."""
    best = []
    for name, template in templates.items():
        size, votes = len(template), {}
        for p in range(len(words) - ls.K + 1):
            for t in range(size - ls.K + 1):
                if words[p:p + ls.K] == template[t:t + ls.K]:
                    votes.setdefault(p - t, set()).add(t)
        bands = []
        for d in sorted(votes):
            if not bands or d - bands[-1][-1] > ls.MERGE_GAP:
                bands.append([])
            bands[-1].append(d)
        for band in bands:
            cast = sum(len(votes[d]) for d in band)
            if cast < max(1, ls.MIN_VOTES * (size - ls.K + 1)):
                continue
            parts = {(band[0], band[-1])} | {(a, b) for a in band for b in band if 0 <= b - a <= size}
            found = []
            for low, high in parts:
                begin, end = max(0, low), min(len(words), high + size)
                a, b = " ".join(words[begin:end]), " ".join(template)
                longer = max(len(a), len(b))
                if min(len(a), len(b)) >= ls.MIN_SIMILARITY * longer:
                    found.append((1 - plain_levenshtein(a, b) / longer, -begin, end))
            if found and max(found)[0] >= ls.MIN_SIMILARITY:
                best.append((name, *max(found), cast))
    nearest = {}
    for _, similarity, back, _, _ in best:
        nearest[back] = max(similarity, nearest.get(back, 0))
    return {(n, -back, end, cast, round(s, 9)) for n, s, back, end, cast in best if s == nearest[back]}


def test_spans_equal_a_plain_search(spark):
    """Edited, repeated and overlapping notices among random words."""
    rng = random.Random(6)
    templates = {"one": split("use copy and share this work freely but keep the name of its maker"),
                 "two": split("use copy and share this work freely but keep the names of all its makers"),
                 "three": split("no warranty is given")}
    frame = spark.createDataFrame([(n, n, w, " ".join(w)) for n, w in templates.items()],
                                  "template string, label string, t_words array<string>, t_text string")
    texts = []
    for row in range(120):
        words = []
        for _ in range(rng.randint(1, 4)):
            words += edge.words(rng.randrange(99), rng.randint(0, 6)).lower().split()
            copy = list(rng.choice(list(templates.values())))
            for _ in range(rng.choice((0, 0, 1, 2, 4))):
                at = rng.randrange(len(copy))
                copy[at:at + rng.randint(0, 1)] = rng.choice(([], ["new"], ["work"]))
            words += copy
        texts.append((row, " ".join(words)))
    got = {row: set() for row, _ in texts}
    for s in ls.find_spans(spark.createDataFrame(texts, "row long, text string"), frame).collect():
        got[s.row].add((s.template, s.first_word, s.end_word, s.votes, round(s.similarity, 9)))
    found = {row: plain_spans(split(t), templates) for row, t in texts}
    assert got == found and sum(map(len, found.values())) > 150


def test_labels_and_score_follow_from_spans_and_phrases(spark):
    docs = edge.documents(spark, TEXTS)
    spans = {}
    for s in ls.find_spans(docs.selectExpr("xxhash64(doc_id, text) AS row", "text"), ls.template_table(spark)).collect():
        spans.setdefault(s.row, []).append(s)
    keys = {(r.doc_id, r.text): r.row for r in docs.selectExpr("doc_id", "text", "xxhash64(doc_id, text) AS row").collect()}
    want = []
    for doc_id, text in TEXTS:
        own, named = spans.get(keys[doc_id, text], []), base(text)
        labels = {s.label for s in own} | set(filter(None, named[4].split(",")))
        want.append((str(doc_id), ",".join(sorted(labels)), 1.0 if named[1] else max((s.similarity for s in own), default=0.0)))
    assert sorted((str(r.doc_id), r.labels, r.score) for r in ls.scan(docs).collect()) == sorted(want)


def test_empty_table(spark):
    assert ls.scan(edge.no_documents(spark)).collect() == []
