"""The divergence audit against plain Python: groups without terms, colliding digests, tiles of sources, ties, edge rows."""

import random
import re
from collections import Counter, defaultdict

import pytest

import edge
from compare import connect, difference
from tallyworks.llm import divergence
from tallyworks.llm.oracle import ORACLE
from tallyworks.llm.queries import op12_term_divergence

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs, top):
    """The result by its definition; rows are (text, lang, source)."""
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        found = TERM.findall((text or "").translate(LOWER))
        count[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, source in groups:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)
        names = sorted(s for other, s in groups if other == lang)

        def shares(counts):
            total = sum(counts[t] for t in kept) + 2 * v
            return {t: 1 + 10**9 * (counts[t] + 2) // total for t in kept}

        def parted(a, b):
            return (a - b) ** 2 // (a + b)

        p = shares(count[lang, source])
        q = shares(sum((count[lang, s] for s in names), Counter()))
        pairs = []
        for other in names:
            if other != source:
                r = shares(count[lang, other])
                pairs.append((other, sum(parted(p[t], r[t]) for t in kept)))
        terms = [(t, parted(p[t], q[t])) for t in kept if count[lang, source][t] > 0 and p[t] > q[t]]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
            out |= {(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)}
    return out


def sample(seed, sources=7):
    rng = random.Random(seed)
    words = ["alpha", "Beta", "gämma", "δ", "e", "日本", "ALPHA", "eta", "theta", "iota", "x" * 50, "Ärger"]
    rows = [(None, "xx", "quiet"), ("", "xx", None), ("123 ...", "zz", "lone"), ("alone", None, "one"), ("alone", None, None)]
    for _ in range(300):
        s = rng.randrange(sources)
        lang = rng.choice(["aa", "bb", None, "aa"])
        text = " ".join(rng.choice(words[: 3 + s] if rng.random() < 0.8 else words) for _ in range(rng.randint(0, 30)))
        rows.append((text.replace(" ", rng.choice([" ", "-", "1"])), lang, f"s{s}" if s else None))
    return rows + rows[20:25] * 3


def frame(spark, rows):
    wide = [(k, *r, 5, 6, "d", "t", 7) for k, r in enumerate(rows)]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, n long, at long, digest string, "
                                       "term string, total long").repartition(5)


@pytest.mark.parametrize("options", [{}, {"tile": 2}, {"tile": 3, "bits": 3}, {"bits": 1}])
def test_equals_the_definition(spark, options):
    rows = sample(3)
    got = divergence.audit(frame(spark, rows), min_docs=4, top=3, **options)
    got = [tuple(r) for r in got.collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, 4, 3)


def test_ties_at_the_last_rank_are_ordered_by_bytes(spark):
    rows = [("zz yy xx ww ää bb", "l", "one")] * 4 + [("other", "l", "two")] * 4
    got = divergence.audit(frame(spark, rows), min_docs=2, top=3)
    terms = sorted((r["rank"], r["item"]) for r in got.collect() if r["part"] == "term" and r["source"] == "one")
    assert terms == [(1, "bb"), (2, "ww"), (3, "xx")]


def test_language_without_kept_terms_has_pairs_of_zero(spark):
    rows = [("a", "l", "one"), ("b", "l", "two"), ("c", "l", None)]
    got = {tuple(r) for r in divergence.audit(frame(spark, rows)).collect()}
    assert got == plain(rows, 10, 10) and {r[4] for r in got} == {0} and len(got) == 6


def test_edge_rows_and_empty_table(spark):
    docs = edge.documents(spark)
    want = plain([(r["text"], r["lang"], r["source"]) for r in docs.collect()], 2, 10)
    assert {tuple(r) for r in divergence.audit(docs, min_docs=2).collect()} == want
    assert divergence.audit(edge.no_documents(spark)).count() == 0


def test_shares_are_exact_for_large_counts(spark):
    from pyspark.sql import functions as F
    pairs = [(0, 2), (7, 11), (10**15, 3 * 10**15 + 1), (9 * 10**15 - 4, 9 * 10**15), (1, 10**15 + 7)]
    got = spark.createDataFrame(pairs, "n long, total long").select(divergence.share(F.col("n"), F.col("total"))).collect()
    import numpy as np
    want = [1 + 10**9 * (n + 2) // total for n, total in pairs]
    assert [r[0] for r in got] == want
    assert divergence._shares(*(np.array(c, np.int64) for c in zip(*pairs))).tolist() == want


def test_query_against_sql(spark):
    d = "/root/testdata/sf0.001"
    assert difference(op12_term_divergence(spark, d), connect(d), ORACLE["op12_term_divergence"]) is None
