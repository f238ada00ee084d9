"""Quality rules against numpy, the Jaccard join against all pairs, and the pipeline as a whole."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
import edge
from tallyworks.llm import chosen_path as cp, quality_rules as qr
from tallyworks.llm.components import components
from tallyworks.llm.staging import ship_package

SPACE = "[^\x20\x09-\x0D]+"


def statistics(text):
    text = text or ""
    w = re.findall(SPACE, text)
    seen, covered, lines, dups = Counter(zip(w, w[1:], w[2:])), set(), set(), 0
    for k in range(len(w) - 2):
        if seen[tuple(w[k:k + 3])] > 1:
            covered |= {k, k + 1, k + 2}
    for line in text.split("\n"):
        if re.search(SPACE, line):
            dups += line in lines
            lines.add(line)
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered), failed


def test_base_statistics(spark):
    rng = random.Random(6)
    texts = list(edge.TEXTS)
    for k in range(60):
        parts = [rng.choice(["ab", "c", "ö#", "|", "\n", "  ", "\t", "x y z", "x y z\n", "\x85", "日本"]) for _ in range(rng.randint(0, 200))]
        texts.append((100 + k, " ".join(parts)))
    got = qr.judge(edge.documents(spark, texts)).collect()
    key = str
    assert sorted(((r.row.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in got), key=key) == sorted(((i, *statistics(t)) for i, t in texts), key=key)
    assert all(not r.kept for r in got if r.base_failed)
    assert qr.judge(edge.no_documents(spark)).collect() == []


def prose(seed):
    return edge.words(seed, 60 + seed % 90)


def test_outliers_go_and_clean_rows_stay(spark):
    clean = [(k, prose(k), "en" if k % 4 else "de", f"s{k % 2}") for k in range(600)]
    bad = [(1000 + k, " ".join(w + "###" for w in prose(k).split()), "en", "s0") for k in range(12)]
    bad += [(2000 + k, "\n".join([prose(k)[:40]] * 3 + prose(k + 1).split() * 1), "en", "s1") for k in range(0)]
    docs = spark.createDataFrame(clean + bad, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in qr.keep_good(docs).collect()}
    assert not kept & {b[0] for b in bad}
    assert len(kept) >= 0.99 * len(clean)
    plan = qr.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_a_row_that_is_an_outlier_only_in_combination_goes(spark):
    """1 of 5 lines repeated and some repeated windows: no statistic is 0.3 off, the vector is."""
    clean = [(k, prose(k), "en", "s0") for k in range(600)]
    line = edge.words(9001, 8)
    bad = "\n".join([line, *(edge.words(9010 + k, 16) for k in range(3)), line])
    plain = "\n".join(edge.words(9020 + k, 16) for k in range(5))
    docs = spark.createDataFrame([*clean, (1000, bad, "en", "s0"), (1001, plain, "en", "s0")],
                                 "doc_id long, text string, lang string, source string")
    judged = {r.row.doc_id: r for r in qr.judge(docs).collect()}
    assert not judged[1000].base_failed and not judged[1000].kept and judged[1001].kept
    cut = qr.chi2_quantile(1 - qr.CUTOFF_CHANCE, 5)
    assert all(r.kept == (r.outlier_distance <= cut) for r in judged.values() if not r.base_failed)
    assert judged[1000].n_dup_lines == 1 and judged[1000].n_repeat_words < 0.3 * judged[1000].n_words


def test_a_small_group_is_judged_by_its_own_estimate(spark):
    rows = [(k, prose(k), "en", "s0") for k in range(600)]
    rows += [(1000 + k, " ".join(w * 3 for w in prose(k).split()), "en", "s1") for k in range(60)]
    kept = {r.doc_id for r in qr.keep_good(spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string")).collect()}
    assert len([i for i in kept if i >= 1000]) >= 57


def test_small_groups_are_drawn_towards_their_language_without_a_jump(spark):
    """The estimate of a group is the mixture of its own and its language's; no number of rows changes the rule."""
    for n in (1, 2, 24, 25, 26):
        rows = [(k, prose(k), "en", "s0") for k in range(200)] + [(1000 + k, prose(500 + k), "en", "s1") for k in range(n)]
        rows += [(2000, " ".join(w + "###" for w in prose(7).split()), "en", "s1")]
        judged = {r.row.doc_id: r for r in qr.judge(spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string")).collect()}
        assert abs(judged[1000].own_share - (n + 1) / (n + 1 + qr.PRIOR_ROWS)) < 1e-9
        assert all(judged[1000 + k].kept for k in range(n))
        assert judged[2000].kept == (n < 3)  # of two or three texts one cannot be told to be the odd one


def test_shrinking_equals_numpy(spark):
    rng = np.random.default_rng(4)
    fields, values, parts = qr._estimate_columns(), {"n_rows": 10}, {}
    for prefix in ("", "w_"):
        mean, a = rng.normal(size=5), rng.normal(size=(5, 5))
        cov = a @ a.T + np.eye(5)
        lower = np.linalg.cholesky(cov)
        parts[prefix] = (mean, cov)
        values |= {f"{prefix}{f}": float(mean[int(f[1])] if f[0] == "m" else lower[int(f[1]), int(f[2])]) for f in fields}
    got = qr._shrunk(spark.createDataFrame([values])).first()
    share = 10 / (10 + qr.PRIOR_ROWS)
    (m, c), (wm, wc) = parts[""], parts["w_"]
    lower = np.linalg.cholesky(share * c + (1 - share) * wc + share * (1 - share) * np.outer(m - wm, m - wm))
    assert np.allclose([got[f"m{k}"] for k in range(5)], share * m + (1 - share) * wm)
    assert np.allclose([got[f"l{i}{j}"] for i in range(5) for j in range(i + 1)], [lower[i, j] for i in range(5) for j in range(i + 1)])


def test_estimates_equal_numpy_concentration(spark):
    rng = np.random.default_rng(1)
    x = np.round(np.vstack([rng.normal(0, 0.3, (900, 5)) @ (np.eye(5) + 0.3), rng.normal(3, 0.2, (100, 5))]) * 1024) / 1024
    rows = [("en", "s", *map(float, r)) for r in x]
    schema = "lang string, source string, " + ", ".join(f"{s} double" for s in qr.STATS)
    estimate = {r.key.level: r for r in qr.mcd_estimates(spark.createDataFrame(rows, schema)).collect()}[0]

    def from_rows(part):
        factor = qr._consistency(qr.SUPPORT, 5)
        return part.mean(0), factor * np.cov(part.T, bias=True) + qr.RIDGE ** 2 * np.eye(5)

    def concentrate(mean, cov):
        for _ in range(qr.STEPS):
            d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
            cell = np.floor(16 * np.log2(d + 2.0 ** -8))
            cut = np.sort(cell)[int(np.ceil(qr.SUPPORT * len(x))) - 1]
            mean, cov = from_rows(x[cell <= cut])
        return mean, cov

    grid = np.sort(np.floor(x * qr.GRID + 0.5), axis=0)
    at = lambda share: grid[int(np.ceil(share * len(x))) - 1] / qr.GRID
    starts = [(at(0.5), np.diag(np.maximum((at(0.75) - at(0.25)) / (2 * 0.6745), qr.RIDGE) ** 2)), from_rows(x)]
    mean, cov = min((concentrate(*s) for s in starts), key=lambda e: np.linalg.slogdet(e[1])[1])
    lower = np.linalg.cholesky(cov)
    assert np.allclose([estimate[f"m{k}"] for k in range(5)], mean, atol=1e-6)
    assert np.allclose([[estimate[f"l{i}{j}"] if j <= i else 0 for j in range(5)] for i in range(5)], lower, atol=1e-6)
    assert np.abs(mean).max() < 0.1


def test_chi2_quantile():
    assert abs(qr.chi2_quantile(0.95, 5) - 11.0705) < 1e-3


def shingles(text):
    w = re.findall(SPACE, text or "")
    return frozenset(zip(w, w[1:], w[2:], w[3:], w[4:])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def all_pairs(texts):
    """(class, links, copies) of every row by comparing all texts."""
    by_text = defaultdict(list)
    for i, t in texts:
        by_text[t or ""].append(i)
    names, sets = list(by_text), [shingles(t) for t in by_text]
    parent, links = list(range(len(names))), [0] * len(names)

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(names)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both >= cp.SIMILARITY * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    least = {}
    for k, t in enumerate(names):
        ids = [i for i in by_text[t] if i is not None]
        least[find(k)] = min([*ids, *([least[find(k)]] if least.get(find(k)) is not None else [])], default=None)
    return sorted(((i, least[find(k)], links[k], len(by_text[t])) for k, t in enumerate(names) for i in by_text[t]), key=str)


def changed(text, n, seed):
    rng, w = random.Random(seed), text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = f"x{rng.randint(0, 999)}"
    return " ".join(w)


def test_join_equals_all_pairs(spark):
    ship_package(spark)
    texts = list(edge.TEXTS) + [(50, "one two three"), (51, "one two three "), (52, "four words are here")]
    base = {k: edge.words(300 + k, 150) for k in range(4)}
    for k, text in base.items():
        texts += [(1000 * (k + 1) + j, changed(text, j % 9, 31 * k + j)) for j in range(40)]
    # Many near copies of one text: larger than a bucket and than two blocks.
    large = edge.words(999, 220)
    texts += [(9000 + j, changed(large, 1 + j % 5, j)) for j in range(420)]
    texts += [(9900 + j, large) for j in range(30)] + [(None, edge.words(77, 90)), (None, edge.words(77, 90) + " more")]
    got = cp.similarity_join(edge.documents(spark, texts).repartition(4)).collect()
    want = all_pairs(texts)
    assert sorted(((r.doc_id, r.class_id, r.n_copies) for r in got), key=str) == sorted(
        ((i, c, n) for i, c, _, n in want), key=str)
    # All links of a text are counted where its group is one comparison; the large group names one at least.
    small, exact = [r for r in got if not 9000 <= (r.doc_id or 0) < 9930], {i: n for i, _, n, _ in want}
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in small), key=str) == [
        r for r in want if not 9000 <= (r[0] or 0) < 9930]
    assert all((exact[r.doc_id] > 0) <= r.n_links <= exact[r.doc_id] for r in got if 9000 <= (r.doc_id or 0) < 9930)
    check_partners(texts, got)
    kept = cp.keep_one_each(edge.documents(spark, texts)).select("doc_id").collect()
    # Two classes have no id at all.
    assert Counter(r.doc_id for r in kept) == Counter({c: 2 if c is None else 1 for _, c, _, _ in want})


def check_partners(texts, got):
    """The named partner is another text of the class, and the stated similarity is the exact one."""
    by_id = {i: t for i, t in texts}
    for r in got:
        assert (r.similarity is None) == (r.n_links == 0)
        if r.similarity is not None and r.linked_id is not None and r.doc_id is not None:
            a, b = shingles(by_id[r.doc_id]), shingles(by_id[r.linked_id])
            assert r.similarity >= cp.SIMILARITY and abs(r.similarity - len(a & b) / len(a | b)) < 1e-9


def test_texts_outside_the_largest_class_are_compared_with_all(spark):
    """Two families and texts between them, in one large group: sorted blocks alone would not join them all."""
    ship_package(spark)
    rng, base = random.Random(8), edge.words(41, 200).split()
    other = base[:100] + edge.words(42, 100).split()
    families = [[" ".join(w[:190] + [f"u{f}{k}"] + w[190:]) for k in range(260)] for f, w in enumerate((base, other))]
    steps = [" ".join(base[:200 - s] + other[200 - s:]) for s in range(5, 100, 6)]  # each links to the one before
    texts = list(enumerate(families[0] + families[1] + steps))
    rng.shuffle(texts)
    texts = [(k, t) for k, (_, t) in enumerate(texts)]
    rows = spark.createDataFrame([(1, f"{k:04}", t) for k, t in texts], "group long, key string, text string")
    tokens = cp._embedded(rows.select("group", "key", "text").withColumnRenamed("group", "doc_id")).select("key", "tokens")
    found, classes = cp._large_groups(rows.withColumn("group", F.lit("g")), tokens)
    roots = {r.node: r.root for r in classes.collect()}
    want = defaultdict(set)
    for i, c, _, _ in all_pairs(texts):
        want[c].add(f"{i:04}")
    have = defaultdict(set)
    for node, root in roots.items():
        have[root].add(node)
    assert sorted(map(sorted, have.values())) == sorted(sorted(v) for v in want.values() if v & set(roots))
    assert all(r.similarity >= cp.SIMILARITY for r in found.collect())


def test_a_family_of_near_copies_costs_in_proportion_to_its_size(spark, monkeypatch):
    ship_package(spark)
    large, sizes, real = edge.words(999, 120), {}, components

    def watched(edges):
        sizes[m].append(edges.count())
        return real(edges)

    monkeypatch.setattr(cp, "components", watched)
    for m in (1000, 2000, 4000):
        sizes[m] = []
        texts = [(j, changed(large, 1 + j % 3, j)) for j in range(m)]
        rows = cp.similarity_join(spark.createDataFrame(texts, "doc_id long, text string").repartition(8)).collect()
        assert len(rows) == m
        if m == 1000:
            want = {i: c for i, c, _, _ in all_pairs(texts)}
            assert sum(want[r.doc_id] == r.class_id for r in rows) >= 0.99 * m
        assert max(sizes[m]) < 6 * m, sizes


def family(n):
    """Near copies of a text, cut to lengths of two bands."""
    large = edge.words(999, 220)
    return [(j, " ".join(changed(large, j % 5, j).split()[:220 - 7 * (j % 11)])) for j in range(n)]


def test_all_links_of_a_large_group_are_counted(spark, monkeypatch):
    """the group is many blocks, and links between blocks count as well."""
    ship_package(spark)
    monkeypatch.setattr(cp, "BLOCK", 60)
    texts = family(400)
    got = cp.similarity_join(edge.documents(spark, texts).repartition(4)).collect()
    assert sorted((r.doc_id, r.class_id, r.n_links, r.n_copies) for r in got) == sorted(all_pairs(texts))
    check_partners(texts, got)


def test_every_pair_of_like_size_meets_in_one_comparison(spark, monkeypatch):
    monkeypatch.setattr(cp, "BLOCK", 8)
    monkeypatch.setattr(cp, "BLOCK_SHINGLES", 4000)
    rng = random.Random(3)
    size = {("g", f"{k:03}"): rng.choice([1, 2, 40, 50, 60, 75, 900, 1100]) for k in range(200)}
    size |= {("one", f"{k:03}"): 10 + k for k in range(8)}
    rows = [(g, k, n, bytearray(b"")) for (g, k), n in size.items()]
    dealt = cp._dealt(spark.createDataFrame(rows, "group string, key string, size long, shingles binary")).collect()
    met, comparisons = Counter(), defaultdict(list)
    for r in dealt:
        assert r.block in (r.low, r.high) and r.whole == (r.group == "one")
        comparisons[r.group, r.low, r.high].append(r)
    for rows in comparisons.values():
        for a in rows:
            met.update((a.group, a.key, b.key) for b in rows if a.key < b.key and (a.low == a.high or a.block != b.block))
    assert set(met.values()) == {1}
    for (g, a), n in size.items():
        for (h, b), m in size.items():
            if g == h and a < b and min(n, m) >= cp.SIMILARITY * max(n, m):
                assert met[g, a, b] == 1
    assert all(sum(size[r.group, r.key] for r in rows) < 30_000 for rows in comparisons.values())


def test_the_join_stores_few_tables(spark, monkeypatch):
    """Each stored table is a stage of its own; on check_h their number decided the time."""
    ship_package(spark)
    names, real = [], cp.staged

    def watched(df, name, *rest):
        names.append(name)
        return real(df, name, *rest)

    monkeypatch.setattr(cp, "staged", watched)
    cp.similarity_join(edge.documents(spark, family(400))).collect()
    assert len(names) <= 11, names


def test_classes_equal_brute_force_on_the_given_documents(spark):
    ship_package(spark)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = all_pairs([(r.doc_id, r.text) for r in docs.collect()])
    got = cp.similarity_join(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == {i: c for i, c, _, _ in want}


def test_join_of_nothing(spark):
    ship_package(spark)
    assert cp.similarity_join(edge.no_documents(spark)).collect() == []
    assert cp.runs_needed(0.99, 1) == 5 and cp.runs_needed(0.99, 4) > cp.runs_needed(0.9, 4)


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5, None), (7000, 7000)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 0 for k in range(301)) and all(got[1000 + k] == 1000 for k in range(200)) and got[7000] == 7000


def test_pipeline_stages(spark):
    ship_package(spark)
    sf_dir = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "quality rules", "n-gram Jaccard join",
                                                     "benchmark decontamination", "packing"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    columns, left = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == columns
        rows = docs.collect()
        now = {r.doc_id: r.text for r in rows}
        assert len(now) == len(rows) and now.items() <= left.items()
        gone = set(left) - set(now)
        if name == "quality classifier":
            assert sum(labels.get(d) == 0 for d in gone) >= 0.7 * sum(labels.get(d) == 0 for d in left)
            assert sum(labels.get(d) == 1 for d in gone) <= 0.03 * len(left)
        if name == "quality rules":
            assert {d for d, t in left.items() if statistics(t)[-1]} <= gone
        if name == "n-gram Jaccard join":
            assert gone == {i for i, c, _, _ in all_pairs(list(left.items())) if i != c}
        left = now
        docs = spark.createDataFrame(rows, docs.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {p.doc_id for p in pieces} == set(left)
