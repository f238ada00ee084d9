"""Fitted operators: held-out accuracy, the split, and defined answers for odd input."""

import random
import re
import zlib

import numpy as np
import pytest

import edge
from tallyworks.llm import labelled, mil, toxicity
from tallyworks.llm.staging import ship_package

TERMS = ["flibbert", "grozznak", "wumpelstink"]


def split_of(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


@pytest.fixture(scope="module")
def corpus():
    """Clean prose; toxic texts with terms; junk with signs and repeats."""
    rng, docs, labels = random.Random(8), [], []
    for k in range(900):
        words = edge.words(k, rng.randint(60, 260)).split()
        quality, toxic = 1, 0
        if k % 6 == 0:
            toxic = 1
            for _ in range(4):
                words.insert(rng.randint(0, len(words)), rng.choice(TERMS))
        elif k % 6 == 1:
            quality = 0
            words = [w + rng.choice(("###", "$$$", "%%%")) for w in words] if k % 2 else words[:9] * 20
        docs.append((k, " ".join(words)))
        labels.append((k, quality, toxic))
    return docs, labels


def frames(spark, corpus):
    ship_package(spark)
    docs, labels = corpus
    return (spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, label string, row int"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_split_is_by_crc32_of_the_id(spark):
    rows = spark.createDataFrame([(k,) for k in range(200)] + [(None,)], "doc_id long")
    got = rows.select("doc_id", labelled.held_out(rows["doc_id"]).alias("h")).collect()
    assert all(r.h == split_of(r.doc_id) for r in got)


def test_training_rows_are_bounded_and_never_held_out(spark, corpus):
    docs, labels = frames(spark, corpus)
    rows = labelled.training_rows(docs, labels, "quality", 200).collect()
    assert 120 <= len(rows) <= 280 and not any(split_of(r.doc_id) for r in rows)


def test_quality_on_held_out_rows(spark, corpus):
    docs, labels = frames(spark, corpus)
    got = {r.doc_id: r for r in mil.score(docs, mil.fit(docs, labels)).collect()}
    truth = {k: q for k, q, _ in corpus[1]}
    out = [k for k in truth if split_of(k)]
    assert all(got[k].held_out == split_of(k) for k in truth)
    assert np.mean([got[k].predicted == truth[k] for k in out]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    kept = {r.doc_id for r in mil.keep_good(docs, mil.fit(docs, labels)).collect()}
    assert kept == {k for k, r in got.items() if r.predicted}


def test_attention_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, begin, y = rng.normal(size=(9, mil.FEATURES)), np.array([0, 1, 4, 9]), np.array([1.0, 0, 1])
    w = {"E": rng.normal(size=(mil.FEATURES, 3)), "e": rng.normal(size=3), "V": rng.normal(size=(3, 2)),
         "U": rng.normal(size=(3, 2)), "w": rng.normal(size=2), "o": rng.normal(size=3), "b": np.array(0.1)}

    def loss():
        p = mil._forward(x, begin, w)["p"]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    grads = mil._gradients(x, y, begin, w)
    for name, value in w.items():
        flat = value.reshape(-1) if value.ndim else value
        at = (0,) if value.ndim else ()
        old = flat[at].copy()
        flat[at] = old + 1e-5
        high = loss()
        flat[at] = old - 1e-5
        low = loss()
        flat[at] = old
        assert abs((high - low) / 2e-5 - np.asarray(grads[name]).reshape(-1)[0]) < 1e-6, name


def test_passages_cover_whole_texts():
    from tallyworks.llm.textgrid import text_blocks
    import pyarrow as pa
    for _, _, data, offsets in text_blocks(pa.array([t for _, t in edge.TEXTS]), block_bytes=1 << 30):
        x, begin = mil.encode(data, offsets)
    counts = [max(1, -(-len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) // mil.PASSAGE_WORDS)) for _, t in edge.TEXTS]
    assert np.diff(begin).tolist() == counts and np.isfinite(x).all()


def plain_features(text):
    """The features of the passages of a text, word by word."""
    raw = (text or "").encode()
    found = [(m.start(), m.end()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)]
    words = [raw[a:b] for a, b in found]
    met = [w in words[:k] for k, w in enumerate(words)]
    trios = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    trio_met = [t in trios[:k] for k, t in enumerate(trios)] + [False, False]
    same = [k > 0 and w == words[k - 1] for k, w in enumerate(words)]
    rows = []
    for low in range(0, max(1, len(words)), mil.PASSAGE_WORDS):
        here = range(low, min(low + mil.PASSAGE_WORDS, len(words)))
        n, some = len(here), max(1, len(here))
        part = raw[found[here[0]][0]:found[here[-1]][1]] if n else b""
        sizes = [len(words[k]) for k in here]
        mean = sum(sizes) / some
        rows.append([sum(c in kind for c in part) / max(1, len(part)) for kind in mil._KINDS] + [
            mean / 10, max(0, sum(s * s for s in sizes) / some - mean * mean) ** 0.5 / 10,
            sum(s <= 3 for s in sizes) / some, sum(s > 20 for s in sizes) / some,
            sum(met[k] for k in here) / some, sum(trio_met[k] for k in here) / some, sum(same[k] for k in here) / some,
            np.log1p(n) / 5, np.log1p(len(words)) / 10])
    return np.array(rows)


def plain_score(model, rows):
    """The forward pass of one document, passage by passage."""
    w = {k: np.asarray(v, float) for k, v in model.weights.items()}
    hidden, votes = [], []
    for row in rows:
        h = np.tanh(((row - model.mean) / model.scale) @ w["E"] + w["e"])
        hidden.append(h)
        votes.append(sum(a * np.tanh(h @ v) / (1 + np.exp(-(h @ u))) for a, v, u in zip(w["w"], w["V"].T, w["U"].T)))
    share = np.exp(np.array(votes) - max(votes))
    share /= share.sum()
    z = sum(a * h for a, h in zip(share, hidden))
    return 1 / (1 + np.exp(-(z @ w["o"] + w["b"]))), int(np.argmax(share)), share


def test_quality_scores_equal_a_plain_forward_pass(spark, corpus):
    docs, labels = frames(spark, corpus)
    model = mil.fit(docs, labels)
    texts = [(k, t) for k, t in edge.TEXTS if len(t or "") < 40_000] + [(100 + k, t) for k, t in corpus[0][:60]]
    texts += [(200, "##a " * 70 + edge.words(4, 150)), (201, "é" * 30 + "\u00a0x\ty\n" + "1,2. | \"z\"!")]
    got = sorted(mil.score(edge.documents(spark, texts), model).collect(), key=lambda r: (str(r.doc_id), r.passages, r.score))
    want = []
    for k, t in texts:
        rows = plain_features(t)
        score, top, share = plain_score(model, rows)
        want.append((k, len(rows), score, top, share))
    want.sort(key=lambda r: (str(r[0]), r[1], r[2]))
    for r, (k, n, score, top, share) in zip(got, want, strict=True):
        assert (r.doc_id, r.passages) == (k, n) and abs(r.score - score) < 1e-3, (k, r.score, score)
        assert r.top_passage == top or share[top] - share[r.top_passage] < 1e-4


def test_training_takes_evenly_spaced_passages_of_very_long_texts():
    assert mil._spread(5, 5 + 512).tolist() == list(range(5, 517))
    many = mil._spread(7, 7 + 5120)
    assert len(many) == 512 and many.tolist() == list(range(7, 7 + 5120, 10))


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_automaton_equals_edit_distance():
    terms, rng = ["abcdefghij", "abcde", "bcd", "bcdea", "edcba"], random.Random(3)
    automaton = toxicity.LexiconAutomaton(terms)
    for _ in range(4000):
        word = list(rng.choice(terms))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(word))
            word[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "e", "z"])
        word = "".join(word)
        near = [(plain_distance(word, t), t) for t in terms if plain_distance(word, t) <= toxicity.allowed_edits(t)]
        assert automaton.match(word) == ((min(near)[1], min(near)[0]) if near else None), word


def test_toxicity_on_held_out_rows_and_misspellings(spark, corpus):
    docs, labels = frames(spark, corpus)
    model = toxicity.fit(docs, labels)
    assert set(model.terms) == set(TERMS)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    truth = {k: t for k, _, t in corpus[1]}
    assert np.mean([got[k].predicted == truth[k] for k in truth if split_of(k)]) > 0.97
    plain, odd = edge.words(1, 30), "fl1bbert grozz*nak wumpelstnk flibbertt"
    texts = [(1, f"{plain} {odd} {plain}"), (2, plain), (3, f'{plain} he said "flibbert" {plain}'),
             (4, f"{plain} you flibbert {plain}")]
    rows = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert rows[1].hits == 4 and rows[1].predicted == 1 and rows[2].predicted == 0
    assert rows[2].score < rows[3].score < rows[4].score


def plain_mass(text, model):
    """Summed hits of an ASCII text by their definition: nearest term, then the context of five words on either side."""
    found = list(re.finditer(r"[0-9a-z]+(?:[*@$!#+][0-9a-z]+)*", text.lower()))
    total = 0.0
    for k, hit in enumerate(found):
        near = min(((plain_distance(hit.group(), t), t) for t in model.terms), default=(9, ""))
        if near[0] > toxicity.allowed_edits(near[1]) or (near[0] and hit.group() in model.natural):
            continue
        value = model.terms[near[1]] * model.edit_factor ** near[0]
        window = found[max(0, k - toxicity.WINDOW):k + toxicity.WINDOW + 1]
        for word in {w.group() for w in window}:
            value *= 0.5 if word in toxicity.REPORTING else 1.25 if word in toxicity.ADDRESS else 1
        before = text[window[0].start():hit.start()]
        after = text[hit.end():window[-1].end() + 2]
        if any(q in before for q in "\"'`") and any(q in after for q in "\"'`"):
            value *= 0.3
        total += value
    return np.log1p(total)


def test_scores_in_context_equal_their_definition(spark):
    """Quotation, reporting and address around exact and misspelled terms, texts lying side by side in a batch."""
    ship_package(spark)
    rng = random.Random(12)
    model = toxicity.ToxicityModel({"flibbert": 0.9, "grozznakker": 0.8, "wump": 1.0}, {"flibberd"}, 1.7, -2.0)
    pool = ["flibbert", "Flibbrt", "flibberd", "grozznakker", "grozz*nakkr", "wump", "wumps", "said", "you", "word",
            "\"", "'", "\"wump\"", "plain", "text", "of", "no", "harm", "x,", "y."]
    texts = [(k, " ".join(rng.choices(pool, k=rng.randint(1, 25)))) for k in range(400)]
    texts += [(400, 'he said "wump'), (401, '"'), (402, '" wump'), (403, "'tis so"), (404, "")]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), model).collect()}
    for k, text in texts:
        want = 1 / (1 + np.exp(-(1.7 * plain_mass(text, model) - 2.0)))
        assert abs(got[k] - want) < 1e-5, (text, got[k], want)


def test_terms_of_any_length_and_scores_by_their_definition(spark):
    ship_package(spark)
    rng, long_word = random.Random(3), "ы" * 90
    plain = [f"w{k}x" for k in range(60)]
    texts, marks = [], []
    for k in range(1200):
        bad = k % 4 == 0
        words = rng.choices(plain, k=rng.randint(8, 30))
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["qz", long_word, "я"])
        if k % 4 == 1:
            words.insert(0, "mild")  # clean and toxic alike
        texts.append((k, " ".join(words)))
        marks.append((k, 1, int(bad)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    folded = [t for t in model.terms if t.startswith("#")]
    assert {"qz", "я"} | set(folded) == set(model.terms) and len(folded) == 1
    known = {**model.terms, long_word: model.terms[folded[0]]}
    for r in toxicity.score(docs, model).collect():
        mass = np.log1p(sum(np.float32(known.get(w, 0)) for w in texts[r.doc_id][1].split()))
        want = 1 / (1 + np.exp(-(model.weight * mass + model.bias)))
        assert abs(r.score - want) < 1e-6 and r.predicted == int(r.score >= 0.5)


@pytest.mark.parametrize("module,label", [(mil, "quality"), (toxicity, "toxic")])
def test_edge_rows_and_missing_labels(spark, corpus, module, label):
    docs, labels = frames(spark, corpus)
    odd = edge.documents(spark)
    for model in (module.fit(odd, labels.limit(0)), module.fit(docs, labels.where(f"{label} = 1"))):
        rows = module.score(odd, model).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in edge.TEXTS)
        assert len({r.score for r in rows}) == 1
    rows = module.score(odd, module.fit(docs, labels)).collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert module.score(edge.no_documents(spark), model).collect() == []
