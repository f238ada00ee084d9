"""Benchmark decontamination: word pair seeds counted by diagonal, then Smith-Waterman alignment.

1. The benchmark is cut into blocks of about `BLOCK_BYTES`; every block goes to the tasks as one table of its word
   pairs (two words that follow each other or have one word between them) and is held against one scan of the texts.
2. Equal pairs of a text and an item are hits. Two matches of an alignment that are no hit cost two errors, a whole
   match, so an alignment of score S has hits of weight S - 1 at different words of the item: 1 where both pairs are of
   neighbours, 0.5 with a word between. Text and item are compared if the hits weigh that much, first in the whole
   text, then on diagonals (text position minus item position) as far apart as an alignment can drift. Both
   bounds hold for every alignment that reaches the score, so no copy is left out, however common its words are.
3. The words around these diagonals are aligned with the item by local alignment: +1 for equal words, -0.5 for
   another word and for a gap. A score of 1 is an exact copy of the whole item. Paraphrased and edited copies keep
   most of it.

Items of fewer than `NGRAM` words hold too little to be told from chance once edited. They are found word for word, by the hash
of all their words, with the score 1.

Words are runs of letters and digits with A-Z lower-cased, so punctuation and case do not matter.

Cases: null and empty texts have no words; an item without words is never found; equal rows are reported each
for itself; equal items are reported each; empty tables give no rows; other columns, also ones named like those used
here, do not matter. A share min_score of an item must be more than one word for the bound of step 2.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyworks.llm.staging import staged
from tallyworks.llm.textgrid import grams, ragged, text_blocks, words

NGRAM = 4
MIN_SCORE = 0.4
BLOCK_BYTES = 4 << 20  # benchmark text of one scan
BITMAP_BITS = 22
EXPANDED = 1 << 20     # hits by item that are counted at once
MISS, GAP = 0.5, 0.5

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _words(column: pa.Array):
    """(first row, end row, hashes, first word of each text)."""
    for first, end, data, offsets in text_blocks(column):
        _, _, hashes, begin = words(_LOWER[data], offsets, _SEPARATOR)
        yield first, end, hashes, begin


def _pairs(hashes: np.ndarray, begin: np.ndarray, text_of: np.ndarray):
    """(hash, first word, whether neighbours) of pairs of words one or two apart; no pair crosses texts."""
    parts = []
    for step in (1, 2):
        at = np.flatnonzero(text_of[:-step] == text_of[step:])
        pair = np.stack([hashes[at], hashes[at + step]], 1).ravel()
        gram, _ = grams(pair, np.arange(0, len(pair), 2), 2)
        parts.append((gram, at, np.full(len(at), step == 1)))
    return tuple(np.concatenate(c) for c in zip(*parts))


def _text_of(begin: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(begin) - 1), np.diff(begin))


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)


class Items:
    """The word pairs of some benchmark items, in order of their hashes and, per item, of their slots."""

    def __init__(self, ids: list, texts: pa.Array, n: int, min_score: float):
        parts, self.ids = [], []
        self.short: dict[int, dict[int, list]] = {}  # items of fewer than n words: number of words, hash, ids
        for first, end, hashes, begin in _words(texts):
            for k in range(first, end):
                own = hashes[begin[k - first]:begin[k - first + 1]]
                if len(own) >= n:
                    parts.append(own)
                    self.ids.append(ids[k])
                elif len(own):
                    whole = int(grams(own, np.array([0, len(own)]), len(own))[0][0])
                    self.short.setdefault(len(own), {}).setdefault(whole, []).append(ids[k])
        self.min_score = min_score
        self.hashes = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        self.sizes = np.array([len(x) for x in parts], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.item_of = _text_of(self.begin)
        # In halves; two words that match apart from a hit cost 2 * 0.5, one match.
        self.need = np.maximum(1, np.ceil(2 * (min_score * self.sizes - 1) - 1e-6)).astype(np.int64)
        self.drift = np.floor((1 - min_score) * self.sizes / GAP + 1e-6).astype(np.int64)
        gram, word, near = _pairs(self.hashes, self.begin, self.item_of)
        order = np.lexsort((word, gram))
        gram, self.word, self.near = gram[order], word[order], near[order]
        self.first = _runs(gram)
        self.grams = gram[self.first]
        self.count = np.diff(np.append(self.first, len(gram)))
        slot = np.repeat(np.arange(len(self.grams)), self.count)
        own = np.lexsort((slot, self.item_of[self.word]))
        self.own_slot, self.own_word, self.own_near = slot[own], self.word[own], self.near[own]
        self.own_begin = np.searchsorted(self.item_of[self.own_word], np.arange(len(self.sizes) + 1))

    def bitmap(self) -> np.ndarray:
        out = np.zeros(1 << BITMAP_BITS, bool)
        out[self.grams >> np.uint64(64 - BITMAP_BITS)] = True
        return out

    def word_for_word(self, hashes: np.ndarray, begin: np.ndarray):
        """(text, item id, places, first word, end word) of the items of few words."""
        text_of = _text_of(begin)
        for size, known in sorted(self.short.items()):
            gram, at = grams(hashes, begin, size)
            hit = np.flatnonzero(np.isin(gram, np.array(sorted(known), np.uint64)))
            order = hit[np.lexsort((at[hit], gram[hit], text_of[at[hit]]))]
            keys = text_of[at[order]]
            edges = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (gram[order][1:] != gram[order][:-1])])) \
                if len(order) else np.zeros(0, np.int64)
            for a, b in zip(edges, [*edges[1:], len(order)]):
                places, free = 0, -1
                for word in at[order[a:b]].tolist():
                    if word >= free:
                        places, free = places + 1, word + size
                t = int(keys[a])
                low = int(at[order[a]] - begin[t])
                for item_id in known[int(gram[order[a]])]:
                    yield t, item_id, places, low, low + size

    def candidates(self, hashes: np.ndarray, begin: np.ndarray, bitmap: np.ndarray):
        """(text, item, [(first word, end word)]): where an alignment may reach the score."""
        text_of = _text_of(begin)
        gram, at, near = _pairs(hashes, begin, text_of)
        keep = np.flatnonzero(bitmap[gram >> np.uint64(64 - BITMAP_BITS)])
        gram, at, near = gram[keep], at[keep], near[keep]
        slot = np.searchsorted(self.grams, gram)
        keep = np.flatnonzero(self.grams[np.minimum(slot, len(self.grams) - 1)] == gram)
        slot, at, near = slot[keep], at[keep], near[keep]
        order = np.argsort(text_of[at], kind="stable")
        slot, at, near, text = slot[order], at[order], near[order], text_of[at][order]
        bounds = np.searchsorted(text, np.arange(len(begin)))
        for t, item in self._heavy(text, slot, near):
            mine = slice(bounds[t], bounds[t + 1])
            places = self._places(item, slot[mine], at[mine] - begin[t], near[mine], int(begin[t + 1] - begin[t]))
            if places:
                yield t, item, places

    def _heavy(self, text: np.ndarray, slot: np.ndarray, near: np.ndarray):
        """(text, item) whose hits weigh enough, wherever they are; a pair that a text repeats counts once."""
        once = np.unique(((text * len(self.grams) + slot) << 1) | ~near)
        near, slot = (once & 1) == 0, (once >> 1) % max(1, len(self.grams))
        text = (once >> 1) // max(1, len(self.grams))
        upto = np.cumsum(self.count[slot])
        k = 0
        while k < len(text):
            # Whole texts up to the bound, or one with more; a text has at most as many as the items have pairs.
            done = upto[k - 1] if k else 0
            end = int(np.searchsorted(upto, done + EXPANDED, "right"))
            if end < len(text):
                begun = int(np.searchsorted(text, text[end]))
                end = begun if begun > k else int(np.searchsorted(text, text[end], "right"))
            part = slice(k, end)
            entry = ragged(self.first[slot[part]], self.count[slot[part]])
            both = np.repeat(near[part], self.count[slot[part]]) & self.near[entry]
            code = np.repeat(text[part], self.count[slot[part]]) * len(self.hashes) + self.word[entry]
            code = np.sort((code << 1) | ~both)
            code = code[_runs(code >> 1)]
            pair = (code >> 1) // len(self.hashes) * len(self.sizes) + self.item_of[(code >> 1) % len(self.hashes)]
            starts = _runs(pair)
            pair = pair[starts]
            enough = np.add.reduceat(2 - (code & 1), starts) >= self.need[pair % len(self.sizes)]
            for x in pair[enough].tolist():
                yield divmod(x, len(self.sizes))
            k = end

    def _places(self, item: int, slot: np.ndarray, pos: np.ndarray, near: np.ndarray, n_words: int):
        """Runs of words around the diagonals whose hits weigh enough."""
        own = slice(self.own_begin[item], self.own_begin[item + 1])
        low, high = (np.searchsorted(self.own_slot[own], slot, side) for side in ("left", "right"))
        entry = self.own_begin[item] + ragged(low, high - low)
        item_pos = self.own_word[entry] - self.begin[item]
        both = np.repeat(near, high - low) & self.own_near[entry]
        size, drift = int(self.sizes[item]), int(self.drift[item])
        # An alignment drifts over two bands at most, so it is whole in one of all pairs of neighbours.
        band = (np.repeat(pos, high - low) - item_pos + size) // (drift + 1) + 1
        code = np.concatenate([band, band - 1]) * size + np.tile(item_pos, 2)
        code = np.sort((code << 1) | ~np.tile(both, 2))
        code = code[_runs(code >> 1)]
        band = (code >> 1) // size
        starts = _runs(band)
        enough = np.add.reduceat(2 - (code & 1), starts) >= self.need[item]
        places = []
        for b in band[starts][enough].tolist():
            first = max(0, (b - 1) * (drift + 1) - size)
            end = min(n_words, (b + 1) * (drift + 1))
            if places and first <= places[-1][1]:
                places[-1] = (places[-1][0], end)
            else:
                places.append((first, end))
        return places


def align_ends(text: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(best score, first word) of the local alignments that end before each word of the text and after the last.

    A gap row is solved with one running maximum: leaving out j words costs j gaps.
    """
    m = len(text)
    drop = np.arange(m + 1) * GAP
    row, start = np.zeros(m + 1), np.arange(m + 1)
    best, first = np.zeros(m + 1), np.arange(m + 1)
    for word in item:
        step = np.where(text == word, 1.0, -MISS)
        diagonal, above = row[:-1] + step, row[1:] - GAP
        new, origin = np.zeros(m + 1), np.arange(m + 1)
        take = (diagonal >= above) & (diagonal > 0)
        new[1:][take], origin[1:][take] = diagonal[take], start[:-1][take]
        take = (above > diagonal) & (above > 0)
        new[1:][take], origin[1:][take] = above[take], start[1:][take]
        lifted = new + drop
        peak = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == peak, np.arange(m + 1), 0))
        value = peak - drop
        row = np.maximum(value, 0.0)
        start = np.where(value > 0, origin[source], np.arange(m + 1))
        better = row > best
        best[better], first[better] = row[better], start[better]
    return best, first


def align(text: np.ndarray, item: np.ndarray) -> tuple[float, int, int]:
    """(best score, first word, end word) of a local alignment of two sequences of word hashes."""
    best, first = align_ends(text, item)
    at = int(best.argmax())
    return (float(best[at]), int(first[at]), at) if best[at] > 0 else (0.0, 0, 0)


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, n: int = NGRAM, min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, item_id, score, places, first_word, end_word, row): benchmark items in training texts, each pair once
    per training row, with its best place. `row` is the hash of the row's id and text.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        _row_key().alias("row"))
    total = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    found = None
    for k in range(blocks):
        # One block at a time comes to the driver.
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).toArrow()
        index = Items(block.column(0).to_pylist(), block.column(1), n, min_score)
        part = texts.mapInArrow(_aligned(index), "doc_id long, item_id long, score double, places long, "
                                                 "first_word long, end_word long, row long")
        found = part if found is None else found.unionByName(part)
    return found


def _aligned(index: Items):
    names = ["doc_id", "item_id", "score", "places", "first_word", "end_word", "row"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = index.bitmap()
        for batch in batches:
            for first, _, hashes, begin in _words(batch.column(1)):
                rows = []
                for t, item_id, *place in index.word_for_word(hashes, begin):
                    doc_id, row = (batch.column(c)[first + t].as_py() for c in (0, 2))
                    rows.append((doc_id, item_id, 1.0, *place, row))
                for t, item, places in index.candidates(hashes, begin, bitmap) if index.ids else ():
                    best = _best_place(hashes[begin[t]:begin[t + 1]],
                                       index.hashes[index.begin[item]:index.begin[item + 1]], places, index.min_score)
                    if best:
                        doc_id, row = (batch.column(c)[first + t].as_py() for c in (0, 2))
                        rows.append((doc_id, index.ids[item], *best, row))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return run


def _best_place(text: np.ndarray, item: np.ndarray, places: list[tuple[int, int]], min_score: float):
    """(score, places that reach the score, first word, end word) or None; places do not overlap, the best come first."""
    count, best = 0, None
    for low, high in places:
        score, first = align_ends(text[low:high], item)
        score = np.round(score / len(item), 6)
        ends = np.flatnonzero(score >= min_score)
        while len(ends):
            end = ends[score[ends].argmax()]
            count += 1
            if best is None or score[end] > best[0]:
                best = (float(score[end]), low + int(first[end]), low + int(end))
            ends = ends[(ends <= first[end]) | (first[ends] >= end)]
    return None if best is None else (best[0], count, best[1], best[2])


def drop_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """`docs` without the rows that hold a benchmark item; other rows of a leaking row's id, null or not, stay."""
    found = staged(leaks.select(F.col("row").alias("leaking_row")).distinct(), "leaking-rows")
    return docs.join(found, _row_key() == F.col("leaking_row"), "left_anti")
