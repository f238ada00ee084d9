"""Token counts of a unigram tokenizer by dynamic programming over a trie.

A text's pre-tokens are its words, each with the word mark in front. The best segmentation of a pre-token into
vocabulary pieces maximises the sum of their log-probabilities; its forward scores at a prefix depend on that
prefix alone. The distinct new pre-tokens of a batch are sorted, which lays them out as the nodes of a trie level
by level: a node is a prefix that the word before does not share, and its score is computed once, for all nodes of
a level together. The count at a word's last node is kept, so a repeated word costs a look-up. Words of more than
`LONG` bytes share little but are deep, so they are segmented one by one: all places of all pieces are looked up in arrays, a
stretch at a time, and the recurrence runs over the places found.

Texts never leave their task: the work is one scan without a shuffle, and the tables of a worker are bounded.

Log-probabilities follow Zipf's law over the rank of a piece in the vocabulary file, which holds ranks only. A byte
that no piece covers is a token of its own with a lower score. Of equal scores the shorter last piece wins.

Cases: null and empty texts have no tokens; words of any length are segmented; repeated rows are counted each for
itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyworks.llm.textgrid import HashIndex, ragged, span_hashes, text_blocks, words

MARK = "▁".encode()
LONG = 512
STRETCH = 1 << 18  # bytes of a long word that are looked up at once
_MODELS: dict[str, "UnigramCounter"] = {}


def zipf_scores(model_file: str) -> dict[bytes, float]:
    """Log-probability of each piece of a sentencepiece file by its rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces = [model.id_to_piece(i).encode() for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    total = math.log(sum(1 / (k + 1) for k in range(len(pieces))))
    return {piece: -math.log(k + 1) - total for k, piece in enumerate(pieces)}


class UnigramCounter:
    """Counts per distinct pre-token; `limit` words are held before the table starts anew."""

    def __init__(self, scores: dict[bytes, float], limit: int = 1_200_000):
        texts = list(scores)
        data = np.frombuffer(b"".join(texts), np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        self.pieces = HashIndex(18)
        self.pieces.add(span_hashes(data, ends - [len(t) for t in texts], ends))
        self.scores = np.array([scores[t] for t in texts])
        self.longest = max(map(len, texts), default=1)
        self.fallback = float(self.scores.min()) - 10 if texts else -10.0
        self.limit = limit
        self._reset()

    def _reset(self) -> None:
        self.words, self.counts = HashIndex(), np.zeros(0, np.int64)

    def count(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(words, tokens) of each text."""
        starts, ends, hashes, first = words(data, offsets)
        if self.words.size > self.limit:
            self._reset()
        at = self.words.find(hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh, where = np.unique(hashes[new], return_index=True)
            self.words.add(fresh)
            where = new[where]
            self.counts = np.concatenate([self.counts, self._segment(data, starts[where], ends[where])])
            at[new] = self.words.find(hashes[new])
        sums = np.concatenate([[0], np.cumsum(self.counts[at])])
        return np.diff(first), sums[first[1:]] - sums[first[:-1]]

    def _segment(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Token counts of distinct words, in groups of similar length."""
        out = np.zeros(len(starts), np.int64)
        lengths = ends - starts + len(MARK)
        group = np.ceil(np.log2(lengths)).astype(int)
        for k in np.flatnonzero(lengths > LONG).tolist():
            out[k] = self._long(np.concatenate([np.frombuffer(MARK, np.uint8), data[starts[k]:ends[k]]]))
            group[k] = -1
        for g in np.unique(group[group >= 0]):
            rows = np.flatnonzero(group == g)
            step = max(1, (1 << 21) >> int(g))
            for k in range(0, len(rows), step):
                part = rows[k:k + step]
                out[part] = self._trie(data, starts[part], lengths[part])
        return out

    def _trie(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n, deep = len(starts), int(lengths.max())
        grid = np.zeros((n, deep), np.uint8)
        grid[:, :len(MARK)] = np.frombuffer(MARK, np.uint8)
        body = lengths - len(MARK)
        grid[np.repeat(np.arange(n), body), ragged(np.full(n, len(MARK)), body)] = data[ragged(starts, body)]
        order = np.argsort(grid.view(f"S{deep}").ravel(), kind="stable")
        grid, lengths = grid[order], lengths[order]
        # The first column in which a word differs from the one before: its nodes beyond that are new.
        differs = np.ones((n, deep), bool)
        differs[1:] = grid[1:] != grid[:-1]
        shared = np.where(differs.any(axis=1), differs.argmax(axis=1), deep)
        shared[1:] = np.minimum(shared[1:], lengths[:-1])
        shared[0] = 0
        # Scores and counts of every word's node at the last `longest` depths.
        best, count = [np.zeros(n)], [np.zeros(n, np.int64)]
        result = np.zeros(n, np.int64)
        flat = grid.ravel()
        for depth in range(1, deep + 1):
            nodes = np.flatnonzero((lengths >= depth) & (shared < depth))
            score, tokens = np.full(len(nodes), -np.inf), np.zeros(len(nodes), np.int64)
            end = nodes * deep + depth
            for size in range(1, min(depth, self.longest) + 1):
                begin, own = end - size, slice(None)
                piece = self.pieces.find(self._hashes(flat, begin, size))
                gain = np.where(piece >= 0, self.scores[piece], self.fallback if size == 1 else -np.inf)
                value = best[-size][nodes] + gain
                better = value > score
                score[better] = value[better]
                tokens[better] = count[-size][nodes][better] + 1
            # Words that share the node take its values from the word that made it.
            made = np.full(n, -1)
            made[nodes] = np.arange(len(nodes))
            owner = np.maximum.accumulate(made)
            at = np.maximum(owner, 0)
            best.append(score[at] if len(nodes) else best[-1])
            count.append(tokens[at] if len(nodes) else count[-1])
            if len(best) > self.longest:
                best.pop(0)
                count.pop(0)
            ended = lengths == depth
            result[ended] = count[-1][ended]
        out = np.zeros(n, np.int64)
        out[order] = result
        return out

    def _long(self, word: np.ndarray) -> int:
        """Token count of one long word."""
        keep, best, count = self.longest, [0.0], [0]  # at the last `keep` ends and those of the stretch
        for first in range(0, len(word), STRETCH):
            last, low = min(len(word), first + STRETCH), max(0, first - keep)
            part, sizes, ends, gains = word[low:last], [], [], []
            for size in range(1, min(keep, len(part)) + 1):
                begin = np.arange(max(0, first - low + 1 - size), len(part) - size + 1)
                piece = self.pieces.find(span_hashes(part, begin, begin + size))
                at = np.flatnonzero(piece >= 0) if size > 1 else np.arange(len(begin))
                sizes.append(np.full(len(at), size))
                ends.append(begin[at] + size)
                gains.append(np.where(piece[at] >= 0, self.scores[piece[at]], self.fallback))
            sizes, ends, gains = (np.concatenate(x) for x in (sizes, ends, gains))
            order = np.lexsort((sizes, ends))
            bounds = np.searchsorted(ends[order], np.arange(first - low + 1, last - low + 2)).tolist()
            sizes, gains = sizes[order].tolist(), gains[order].tolist()
            for a, b in zip(bounds[:-1], bounds[1:]):
                top, tokens = -math.inf, 0
                for k in range(a, b):
                    value = best[-sizes[k]] + gains[k]
                    if value > top:
                        top, tokens = value, count[-sizes[k]] + 1
                best.append(top)
                count.append(tokens)
            best, count = best[-keep:], count[-keep:]
        return count[-1]

    @staticmethod
    def _hashes(flat: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
        """Hashes of `size` bytes from each position, equal to those of the pieces."""
        rows = flat[(begin[:, None] + np.arange(size)).ravel()]
        ends = np.arange(1, len(begin) + 1) * size
        return span_hashes(rows, ends - size, ends)


def counter(model_file: str) -> UnigramCounter:
    """The worker's counter for this vocabulary."""
    if model_file not in _MODELS:
        _MODELS[model_file] = UnigramCounter(zipf_scores(model_file))
    return _MODELS[model_file]


def token_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(model_file)
        for batch in batches:
            parts = [model.count(data, offsets) for _, _, data, offsets in text_blocks(batch.column(1))]
            if parts:
                columns = [np.concatenate(x) for x in zip(*parts)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)],
                                                 ["doc_id", "n_words", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(count, "doc_id long, n_words long, n_tokens long")
