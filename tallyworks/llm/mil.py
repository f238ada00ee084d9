"""Quality by attention-based multiple-instance learning.

A document is a bag of passages of 64 words. Every passage of the whole text is encoded by shares of character
kinds, word shapes and repetition; a gated attention layer gives each passage a weight within its document,
and a logistic unit scores the weighted mean of the encoded passages. Only documents carry labels: the attention
learns from them which passages decide.

    h = tanh(E x)        a = softmax(w . (tanh(V h) * sigmoid(U h)))        score = sigmoid(o . sum(a h) + b)

The network is small and fitted by Adam on a bounded sample of labelled documents; the passages of these are
encoded by Spark. Scoring is one scan without a shuffle.

Cases: null and empty texts are one passage of zeros; texts of any length are encoded whole, block by block; without
labels of both kinds all documents get the share of label 1 (one half without labels); repeated rows are scored each for
itself; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyworks.llm.labelled import held_out, sigmoid, training_rows
from tallyworks.llm.staging import staged
from tallyworks.llm.textgrid import grams, text_blocks, words

PASSAGE_WORDS = 64
MAX_TRAINING_ROWS = 4_000
MAX_TRAINING_PASSAGES = 512  # of one text; of longer texts evenly spaced ones train the network
THRESHOLD = 0.3
_HIDDEN, _GATE = 24, 12

# Kinds of bytes whose shares describe a passage.
_KINDS = [
    [*range(0x61, 0x7B)], [*range(0x41, 0x5B)], [*range(0x30, 0x3A)], [*range(0x80, 0x100)], [0x2C], [0x2E],
    [ord("|")], [ord(c) for c in "!?"], [ord(c) for c in "#*$%&<>@^~=+_\\/"], [ord(c) for c in "\"'()[]{}:;-"],
    [0x0A],
]
_TABLE = np.zeros((len(_KINDS), 256), np.uint8)
for _k, _members in enumerate(_KINDS):
    _TABLE[_k, _members] = 1
FEATURES = len(_KINDS) + 9


def encode(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of all passages, first passage of each text and the end)."""
    starts, ends, hashes, first = words(data, offsets)
    counts = np.diff(first)
    bags = np.maximum(1, -(-counts // PASSAGE_WORDS))
    begin = np.concatenate([[0], np.cumsum(bags)])
    text = np.repeat(np.arange(len(counts)), bags)
    index = np.arange(begin[-1]) - begin[text]
    low = np.minimum(first[text] + index * PASSAGE_WORDS, first[text + 1])
    high = np.minimum(low + PASSAGE_WORDS, first[text + 1])
    n = high - low
    padded_starts, padded_ends = np.append(starts, len(data)), np.concatenate([[0], ends])
    from_byte = np.where(n > 0, padded_starts[np.minimum(low, len(starts))], 0)
    to_byte = np.where(n > 0, padded_ends[high], 0)
    size = np.maximum(1, to_byte - from_byte)
    out = np.zeros((len(n), FEATURES), np.float32)
    total = np.zeros(len(data) + 1, np.int64)
    for k in range(len(_KINDS)):
        np.cumsum(_TABLE[k][data], out=total[1:])
        out[:, k] = (total[to_byte] - total[from_byte]) / size
    some = np.maximum(1, n)

    def per_word(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
        return (sums[high] - sums[low]) / some

    length = (ends - starts).astype(np.float64)
    mean = per_word(length)
    out[:, -9] = mean / 10
    out[:, -8] = np.sqrt(np.maximum(0, per_word(length * length) - mean * mean)) / 10
    out[:, -7] = per_word(length <= 3)
    out[:, -6] = per_word(length > 20)
    # Words met before in the text, word 3-grams met before in it, and words equal to the one before.
    owner = np.repeat(np.arange(len(counts)), counts)
    out[:, -5] = per_word(_met_before(hashes, owner))
    gram, at = grams(hashes, first, 3)
    seen = np.zeros(len(hashes))
    seen[at] = _met_before(gram, owner[at])
    out[:, -4] = per_word(seen)
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    out[:, -3] = per_word(same)
    out[:, -2] = np.log1p(n) / 5
    out[:, -1] = np.log1p(counts[text]) / 10
    return out, begin


def _met_before(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Whether an earlier entry of the same owner has the value."""
    if not len(values):
        return np.zeros(0)
    key = values ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    out = np.zeros(len(key))
    ranked = key[order]
    out[order[1:]] = ranked[1:] == ranked[:-1]
    return out


def _segment_softmax(value: np.ndarray, begin: np.ndarray, text: np.ndarray) -> np.ndarray:
    top = np.maximum.reduceat(value, begin[:-1])
    e = np.exp(value - top[text])
    return e / np.add.reduceat(e, begin[:-1])[text]


@dataclass
class AttentionModel:
    """Weights of the network; `share` answers when there was nothing to learn."""

    share: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def score(self, x: np.ndarray, begin: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(begin) - 1, self.share)
        return _forward((x - self.mean) / self.scale, begin, self.weights)["p"]

    def attention(self, x: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """The weight of every passage within its document."""
        if self.weights is None:
            n = np.diff(begin)
            return np.repeat(1 / n, n)
        return _forward((x - self.mean) / self.scale, begin, self.weights)["a"]


def _forward(x: np.ndarray, begin: np.ndarray, w: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    h = np.tanh(x @ w["E"] + w["e"])
    t, s = np.tanh(h @ w["V"]), sigmoid(h @ w["U"])
    a = _segment_softmax((t * s) @ w["w"], begin, text)
    z = np.add.reduceat(h * a[:, None], begin[:-1], axis=0)
    return {"text": text, "h": h, "t": t, "s": s, "a": a, "z": z, "p": sigmoid(z @ w["o"] + w["b"])}


def _gradients(x, y, begin, w) -> dict[str, np.ndarray]:
    f = _forward(x, begin, w)
    d = (f["p"] - y) / len(y)
    dz = d[:, None] * w["o"]
    dh = f["a"][:, None] * dz[f["text"]]
    da = np.einsum("ij,ij->i", f["h"], dz[f["text"]])
    mean = np.add.reduceat(da * f["a"], begin[:-1])
    du = f["a"] * (da - mean[f["text"]])
    gate = du[:, None] * w["w"]
    dt, ds = gate * f["s"] * (1 - f["t"] ** 2), gate * f["t"] * f["s"] * (1 - f["s"])
    dh += dt @ w["V"].T + ds @ w["U"].T
    de = dh * (1 - f["h"] ** 2)
    return {"E": x.T @ de, "e": de.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ du,
            "o": f["z"].T @ d, "b": np.array(d.sum())}


def train(x: np.ndarray, begin: np.ndarray, y: np.ndarray, steps: int = 600, batch: int = 128,
          rate: float = 4e-3, decay: float = 1e-4, seed: int = 7) -> AttentionModel:
    """Fit on bags: bag i has the rows begin[i] to begin[i + 1] of x and the label y[i]."""
    share = float((y.sum() + 1) / (len(y) + 2))
    if not len(y) or y.min() == y.max():
        return AttentionModel(share)
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(0), x.std(0) + 0.02
    x = (x - mean) / scale
    w = {"E": rng.normal(0, FEATURES ** -0.5, (FEATURES, _HIDDEN)), "e": np.zeros(_HIDDEN),
         "V": rng.normal(0, _HIDDEN ** -0.5, (_HIDDEN, _GATE)), "U": rng.normal(0, _HIDDEN ** -0.5, (_HIDDEN, _GATE)),
         "w": rng.normal(0, 0.1, _GATE), "o": rng.normal(0, 0.1, _HIDDEN),
         "b": np.array(np.log(share / (1 - share)))}
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(u) for k, u in w.items()}
    order = np.zeros(0, np.int64)
    for step in range(1, steps + 1):
        if len(order) < batch:
            order = np.concatenate([order, rng.permutation(len(y))])
        bags, order = order[:batch], order[batch:]
        n = begin[bags + 1] - begin[bags]
        edges = np.concatenate([[0], np.cumsum(n)])
        rows = np.arange(edges[-1]) + np.repeat(begin[bags] - edges[:-1], n)
        speed = rate * (1 - step / (steps + 1))
        for name, g in _gradients(x[rows], y[bags], edges, w).items():
            m[name] = 0.9 * m[name] + 0.1 * g
            v[name] = 0.999 * v[name] + 0.001 * g * g
            move = m[name] / (1 - 0.9 ** step) / (np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-8)
            w[name] = w[name] - speed * (move + decay * w[name])
    return AttentionModel(share, mean.astype(np.float32), scale.astype(np.float32),
                          {k: np.asarray(u, np.float32) for k, u in w.items()})


def _spread(begin: int, end: int, most: int = MAX_TRAINING_PASSAGES) -> np.ndarray:
    """All of begin .. end, or `most` of them evenly spaced."""
    n = min(most, end - begin)
    return begin + np.arange(n) * (end - begin) // n


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_TRAINING_ROWS) -> AttentionModel:
    """A model from about `max_rows` labelled documents at most.

    The driver gets the features of at most MAX_TRAINING_PASSAGES passages of each, 41 kB a document. All passages count
    when a document is scored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(1)):
                x, begin = encode(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(2)[a:b],
                     pa.array([x[_spread(i, j)].tobytes() for i, j in zip(begin[:-1], begin[1:])], pa.binary())],
                    ["doc_id", "label", "bag"])

    rows = training_rows(docs, labels, label, max_rows).select("doc_id", "text", "label")
    bags = rows.mapInArrow(run, "doc_id long, label int, bag binary").toPandas().sort_values("doc_id", kind="stable")
    if not len(bags):
        return AttentionModel(0.5)
    each = [np.frombuffer(b, np.float32).reshape(-1, FEATURES) for b in bags["bag"]]
    begin = np.concatenate([[0], np.cumsum([len(b) for b in each])])
    return train(np.concatenate(each), begin, (bags["label"] == 1).to_numpy(float))


def score(docs: DataFrame, model: AttentionModel, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, passages, top_passage) of every document; `top_passage` is the
    passage with the largest attention weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(2)):
                value, count, top = score_block(model, data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(value),
                     pa.array((value >= threshold).astype(np.int32)), pa.array(count), pa.array(top)],
                    ["doc_id", "held_out", "score", "predicted", "passages", "top_passage"])

    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, passages long, "
                                "top_passage long")


def score_block(model: AttentionModel, data: np.ndarray, offsets: np.ndarray):
    """(score, passages, passage of the largest weight) of each text of a block."""
    x, begin = encode(data, offsets)
    weight = model.attention(x, begin)
    count = np.diff(begin)
    text = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((np.arange(len(weight)), -weight, text))
    return (model.score(x, begin).astype(np.float64), count.astype(np.int64),
            (order[begin[:-1]] - begin[:-1]).astype(np.int64))


def keep_good(docs: DataFrame, model: AttentionModel, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` whose score reaches the threshold, with the columns they came with."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(batch.schema.get_field_index("text"))):
                x, begin = encode(data, offsets)
                keep = pa.array(model.score(x, begin) >= threshold)
                yield pa.RecordBatch.from_arrays([c[a:b].filter(keep) for c in batch.columns], batch.schema.names)

    return docs.mapInArrow(run, docs.schema)
