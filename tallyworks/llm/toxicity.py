"""Toxicity by a learned lexicon, misspellings included, with the context of every hit.

1. Terms are the words whose documents are toxic more often than chance allows (binomial tail, corrected for
   the number of words) and toxic for the most part (`MIN_PRECISION`), searched anew among the texts that the terms found so far leave unexplained, so that
   rarer languages get their terms too. Near copies count once: documents are told apart by the smallest hash of their word 5-grams.
2. The terms form a trie. A Levenshtein automaton runs over it: its states are sets of (trie node, edits so far), built
   when first met and kept, so a word costs one look-up per character and most words fail after a few. Terms of
   5 letters allow one edit, of 9 two, shorter ones none; words of more than `LONG_WORD` bytes stand for their hash. Words that clean training documents hold are not misspellings.
3. A hit weighs its term's precision, less for edits, and is multiplied by a score of its context window: quotation
   marks around it and words of reporting make it count less, direct address makes it count more.
4. The document's score is a logistic function of the log of its summed hits, fitted on the training rows.

Only distinct words reach the automaton, and their verdicts are kept per worker; texts stay in their task.

Cases: null and empty texts have no hits and get the score of a text without hits; without any label all
documents get the same score; a document with contradictory labels counts as toxic; repeated rows are scored each for itself; empty tables give no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyworks.llm.labelled import fit_logistic, held_out, sigmoid, training_rows
from tallyworks.llm.staging import staged
from tallyworks.llm.textgrid import HashIndex, grams, span_hashes, spans, text_blocks

MAX_TRAINING_ROWS = 20_000
ROUNDS = 3  # searches for terms; each looks only at texts without the terms found so far
MIN_PRECISION = 0.8  # share of toxic ones among the documents of a term
LONG_WORD = 64
WINDOW = 5  # words on either side of a hit

# Words of reporting and of direct address in the languages of the corpus.
REPORTING = ("said says say called calls term word words quote quoted wrote writes title "
             "sagte sagt nannte wort zitat schrieb dit disait mot citation nommé dijo dice palabra cita llamó").split()
ADDRESS = "you your you're u ur du dich dein ihr tu toi ton vous tú eres ti usted".split()

_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_INNER = np.zeros(256, bool)
_INNER[[ord(c) for c in "*@$!#+"]] = True
_QUOTE = np.zeros(256, bool)
_QUOTE[[ord(c) for c in "\"'`"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and of the Latin-1 letters, in place of the same bytes."""
    out = _LOWER[data]
    upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
    out[upper] += 0x20
    return out


def cut_words(data: np.ndarray, offsets: np.ndarray):
    """(starts, ends, hashes, first word of each text) of letter and digit runs.

    Signs such as * or @ between two letters belong to the word ("st*pid").
    """
    inside = _ALNUM[data]
    if len(data) > 2:
        inside[1:-1] |= _INNER[data[1:-1]] & _ALNUM[data[:-2]] & _ALNUM[data[2:]]
    starts, ends = spans(inside, offsets)
    return starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def spelling(raw: bytes, start: int, end: int, word_hash: int) -> str:
    """The word, or its hash where it is too long to be kept as it is."""
    return raw[start:end].decode("utf-8", "replace") if end - start <= LONG_WORD else f"#{word_hash:016x}"


def allowed_edits(term: str) -> int:
    return 2 if len(term) >= 9 else 1 if len(term) >= 5 else 0


class LexiconAutomaton:
    """The Levenshtein automaton of a word read against a trie of terms, made deterministic on demand."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.allow: list[int] = [0]  # most edits of any term below a node
        for term in terms:
            node, k = 0, allowed_edits(term)
            self.allow[0] = max(self.allow[0], k)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.allow.append(0)
                node = self.children[node][c]
                self.allow[node] = max(self.allow[node], k)
            self.term[node] = term
        self.states: dict[frozenset, int] = {}
        self.next: list[dict[str, int]] = []
        self.accept: list[tuple[str, int] | None] = []
        self.sets: list[dict[int, int]] = []
        self.start = self._state({0: 0})

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With letters of the term left out."""
        out, todo = dict(nodes), list(nodes.items())
        while todo:
            node, e = todo.pop()
            for child in self.children[node].values():
                if e < self.allow[child] and out.get(child, 9) > e + 1:
                    out[child] = e + 1
                    todo.append((child, e + 1))
        return out

    def _state(self, nodes: dict[int, int]) -> int:
        nodes = self._closed(nodes)
        key = frozenset(nodes.items())
        if key not in self.states:
            self.states[key] = len(self.next)
            self.next.append({})
            self.sets.append(nodes)
            ends = [(e, self.term[n]) for n, e in nodes.items()
                    if self.term[n] is not None and e <= allowed_edits(self.term[n])]
            self.accept.append((min(ends)[1], min(ends)[0]) if ends else None)
        return self.states[key]

    def _step(self, state: int, c: str) -> int:
        """The next state, -1 when no term can follow."""
        out: dict[int, int] = {}
        for node, e in self.sets[state].items():
            for letter, child in self.children[node].items():
                cost = e + (letter != c)
                if cost <= self.allow[child] and out.get(child, 9) > cost:
                    out[child] = cost
            if e < self.allow[node] and out.get(node, 9) > e + 1:
                out[node] = e + 1
        self.next[state][c] = self._state(out) if out else -1
        return self.next[state][c]

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest term within its allowed edits; ties go to the first in order."""
        state = self.start
        for c in word:
            following = self.next[state].get(c)
            state = self._step(state, c) if following is None else following
            if state < 0:
                return None
        return self.accept[state]


@dataclass
class ToxicityModel:
    """What fitting yields; small enough to travel with a task."""

    terms: dict[str, float]                       # precision of each term
    natural: set[str] = field(default_factory=set)  # near misses that clean documents hold
    weight: float = 1.0
    bias: float = 0.0
    edit_factor: float = 0.7

    def scorer(self) -> "Scorer":
        return Scorer(self)


class Scorer:
    """Hits and scores of blocks of texts; keeps the verdict on every distinct word, up to `limit`."""

    def __init__(self, model: ToxicityModel, limit: int = 1_500_000):
        self.model, self.limit = model, limit
        self.automaton = LexiconAutomaton(sorted(model.terms))
        self.cues = {self._hash(w): f for group, f in ((REPORTING, 0.5), (ADDRESS, 1.25)) for w in group}
        self._reset()

    @staticmethod
    def _hash(word: str) -> int:
        data = np.frombuffer(word.encode(), np.uint8)
        return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])

    def _reset(self) -> None:
        self.seen, self.verdict, self.found = HashIndex(), np.zeros(0, np.float32), {}

    def _judge(self, word: str) -> tuple[str, int, float] | None:
        hit = self.automaton.match(word)
        if hit is None or (hit[1] and word in self.model.natural):
            return None
        return *hit, self.model.terms[hit[0]] * self.model.edit_factor ** hit[1]

    def hits(self, data: np.ndarray, offsets: np.ndarray):
        """(text, word index, start, end, weight in context) of every hit, as arrays."""
        data = lowered(data)
        starts, ends, hashes, first = cut_words(data, offsets)
        if self.seen.size > self.limit:
            self._reset()
        at = self.seen.find(hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh, where = np.unique(hashes[new], return_index=True)
            where, raw = new[where], data.tobytes()
            judged = [self._judge(spelling(raw, *w))
                      for w in zip(starts[where].tolist(), ends[where].tolist(), hashes[where].tolist())]
            self.seen.add(fresh)
            self.verdict = np.concatenate([self.verdict, np.array([j[2] if j else 0 for j in judged], np.float32)])
            at[new] = self.seen.find(hashes[new])
        weight = self.verdict[at].astype(float)
        hit = np.flatnonzero(weight > 0)
        text = np.searchsorted(first, hit, "right") - 1
        context = np.array([self._context(data, hashes, starts, ends, h, first[t], first[t + 1], offsets[t + 1])
                            for h, t in zip(hit.tolist(), text.tolist())])
        return text, hit - first[text], starts[hit], ends[hit], weight[hit] * context

    def _context(self, data, hashes, starts, ends, at: int, low: int, high: int, stop: int) -> float:
        score = 1.0
        a, b = max(low, at - WINDOW), min(high, at + WINDOW + 1)
        for cue in {int(h) for h in hashes[a:b]} & self.cues.keys():
            score *= self.cues[cue]
        before = data[starts[a]:starts[at]]
        after = data[ends[at]:ends[b - 1]] if b - 1 > at else data[:0]
        tail = data[ends[b - 1]:min(ends[b - 1] + 2, stop)]
        if _QUOTE[before].any() and (_QUOTE[after].any() or _QUOTE[tail].any()):
            score *= 0.3
        elif (before[-3:] == 0xAB).any() or (before[-3:] == 0x9C).any() or (before[-3:] == 0x9E).any():
            score *= 0.3  # guillemets and curly quotation marks
        return score

    def mass(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Log of one plus the summed hits of each text."""
        text, _, _, _, weight = self.hits(data, offsets)
        return np.log1p(np.bincount(text, weight, minlength=len(offsets) - 1))

    def score(self, mass: np.ndarray) -> np.ndarray:
        return sigmoid(self.model.weight * mass + self.model.bias)


def _word_rows(rows: DataFrame) -> DataFrame:
    """(word, copy, label): each word of a training text once; near copies mostly share `copy`."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            for begin, end, data, offsets in text_blocks(batch.column(0)):
                data = lowered(data)
                starts, ends, hashes, first = cut_words(data, offsets)
                raw = data.tobytes()
                words, copies, marks = [], [], []
                for k in range(end - begin):
                    own = hashes[first[k]:first[k + 1]]
                    _, where = np.unique(own, return_index=True)
                    gram, _ = grams(own, np.array([0, len(own)]), 5)
                    copy = int((gram if len(gram) else own if len(own) else np.zeros(1, np.uint64)).min() >> np.uint64(1))
                    for i in (where + first[k]).tolist():
                        words.append(spelling(raw, int(starts[i]), int(ends[i]), int(hashes[i])))
                        copies.append(copy)
                        marks.append(labels[begin + k])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words, pa.string()), pa.array(copies, pa.int64()), pa.array(marks, pa.int32())],
                    ["word", "copy", "label"])

    return rows.select("text", "label").mapInArrow(cut, "word string, copy long, label int")


def _tail(a: Column, n: Column, p: float) -> Column:
    """Log of an upper bound of P(X >= a) for n trials of chance p (Chernoff)."""
    q = a / n
    miss = F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - p))).otherwise(0.0)
    return F.when(q <= p, 0.0).otherwise(-n * (q * F.log(q / p) + miss))


def _terms(counts: DataFrame, rows: DataFrame) -> dict[str, float]:
    """Words whose rows are toxic more often than chance allows, with their precision.

    The driver sees only words that are this one-sided in several texts that are not copies of each other.
    """
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = n.get(1, 0) / max(1, sum(n.values()))
    if not 0 < share < 1:
        return {}
    chance = math.log(0.01 / max(1, counts.count()))
    seen = F.col("toxic") + F.col("clean")
    likely = counts.where((F.col("toxic") >= MIN_PRECISION * seen) & (_tail(F.col("toxic"), seen, share) < chance)).collect()
    return {r["word"]: (r["toxic"] + 0.5) / (r["toxic"] + r["clean"] + 1) for r in likely}


def _without(rows: DataFrame, terms: dict[str, float]) -> DataFrame:
    """Rows without any of the terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = ToxicityModel(terms).scorer()
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(0)):
                keep = pa.array(scorer.mass(data, offsets) == 0)
                yield pa.RecordBatch.from_arrays([c[a:b].filter(keep) for c in batch.columns], ["text", "label"])

    return rows.mapInArrow(run, "text string, label int")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_TRAINING_ROWS) -> ToxicityModel:
    """Terms, natural near misses and the logistic curve from at most about `max_rows` training rows."""
    rows = staged(training_rows(docs, labels, label, max_rows), "toxic-training").select("text", "label")
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or len(n) == 1:
        return ToxicityModel({}, weight=0.0, bias=math.log((n.get(1, 0) + 0.5) / (n.get(0, 0) + 0.5)))
    terms: dict[str, float] = {}
    left, first_counts = rows, None
    for _ in range(ROUNDS):
        counts = staged(_word_rows(left).distinct().groupBy("word").agg(
            F.count_if(F.col("label") == 1).alias("toxic"), F.count_if(F.col("label") != 1).alias("clean")),
            "toxic-words")
        first_counts = first_counts or counts
        new = _terms(counts, left)
        if not new:
            break
        terms |= new
        left = staged(_without(rows, terms), "toxic-left")
    counts = first_counts
    model = ToxicityModel(terms)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LexiconAutomaton(sorted(terms))
        for batch in batches:
            keep = [w for w in batch.column(0).to_pylist() if (automaton.match(w) or (None, 0))[1]]
            yield pa.RecordBatch.from_arrays([pa.array(keep, pa.string())], ["word"])

    model.natural = {r["word"] for r in counts.where("clean > 0").select("word")
                     .mapInArrow(near, "word string").collect()}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(0)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(scorer.mass(data, offsets)), batch.column(1)[a:b].cast(pa.int32())], ["mass", "label"])

    seen = rows.select("text", "label").mapInArrow(measure, "mass double, label int").toPandas()
    weights, model.bias = fit_logistic(seen[["mass"]].to_numpy(float), (seen["label"] == 1).to_numpy(float))
    model.weight = max(0.0, float(weights[0]))
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted, hits) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(2)):
                text, _, _, _, weight = scorer.hits(data, offsets)
                mass = np.log1p(np.bincount(text, weight, minlength=b - a))
                value = scorer.score(mass)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(value),
                     pa.array((value >= 0.5).astype(np.int32)),
                     pa.array(np.bincount(text, minlength=b - a).astype(np.int64))],
                    ["doc_id", "held_out", "score", "predicted", "hits"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, hits long")
