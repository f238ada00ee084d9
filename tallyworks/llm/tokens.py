"""Token ids of whole texts, with each distinct piece of text encoded once per worker.

Neither pre-tokenizer lets a token cross the start of a run of white space, nor a comma or full stop between a
letter and white space. Texts therefore fall into pieces that can be encoded apart, and natural text repeats few
distinct pieces. The ids of a piece come from the tokenizers library and are kept in a bounded table of the
worker; a text's ids are gathered from there.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tallyworks.llm.textgrid import HashIndex, SPACE, ragged, span_hashes, spans, text_blocks

_ENCODERS: dict[tuple[str, bool], "Encoder"] = {}

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)
_STOP[[0x2C, 0x2E]] = True
# First bytes of the white space characters beyond ASCII (U+0085, U+00A0, U+1680, U+2000 to U+205F, U+3000).
_WIDE_WHITE = {0xC2: (0x85, 0xA0), 0xE1: (0x9A,), 0xE2: (0x80, 0x81), 0xE3: (0x80,)}


class Encoder:
    """`keep_white`: the tokenizer has tokens for white space (byte-level BPE); otherwise it drops it.

    At most `limit` pieces are held; then the table starts anew, so memory is bounded for any corpus.
    """

    def __init__(self, path: str, keep_white: bool, limit: int = 1_200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.keep_white, self.limit = keep_white, limit
        self._reset()

    def _reset(self) -> None:
        self.index = HashIndex()
        self.first = np.zeros(1, np.int64)  # of a piece in the pool; one more at the end
        self.pool = np.zeros(1 << 16, np.uint32)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        each = self.encode(texts)
        ends = self.first[-1] + np.cumsum([len(x) for x in each])
        while ends[-1] > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.first[-1]:ends[-1]] = [i for x in each for i in x]
        self.first = np.concatenate([self.first, ends])
        self.index.add(hashes)

    def _pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        white = SPACE[data]
        stop = np.zeros(len(data), bool)
        if len(data) > 1:
            after = np.ones(len(data), bool)
            after[:-1] = white[1:]
            after[offsets[1:][offsets[1:] > 0] - 1] = True
            stop[1:] = _STOP[data[1:]] & _LETTER[data[:-1]] & after[1:]
            edge = offsets[:-1][offsets[:-1] < len(data)]
            stop[edge] = False
        if not self.keep_white:
            starts, ends = spans(~white, offsets)
            cut = np.flatnonzero(stop)
            return np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        begin = stop.copy()
        begin[1:] |= white[1:] & ~white[:-1]
        begin[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(begin)
        return starts, np.append(starts[1:], len(data)) if len(starts) else starts

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, position of each text's first id and the end)."""
        starts, ends = self._pieces(data, offsets)
        hashes = span_hashes(data, starts, ends)
        if self.index.size > self.limit:
            self._reset()
        at = self.index.find(hashes)
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh, where = np.unique(hashes[new], return_index=True)
            raw = data.tobytes()
            where = new[where]
            self._learn(fresh, [raw[a:b].decode("utf-8", "replace")
                                for a, b in zip(starts[where].tolist(), ends[where].tolist())])
            at[new] = self.index.find(hashes[new])
        counts = self.first[at + 1] - self.first[at]
        ids = self.pool[ragged(self.first[at], counts)]
        sums = np.concatenate([[0], np.cumsum(counts)])
        return ids, sums[np.searchsorted(starts, offsets)]

    def texts(self, column: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text in turn (null: none), as unsigned 32-bit integers."""
        for first, end, data, offsets in text_blocks(column):
            odd = self._wide_white(data, offsets)
            ids, begin = self.block(data, offsets)
            for k in range(end - first):
                if odd is not None and odd[k]:
                    text = data[offsets[k]:offsets[k + 1]].tobytes().decode("utf-8", "replace")
                    yield np.array(self.encode([text])[0], np.uint32)
                else:
                    yield ids[begin[k]:begin[k + 1]]

    @staticmethod
    def _wide_white(data: np.ndarray, offsets: np.ndarray) -> np.ndarray | None:
        """Which texts may hold white space beyond ASCII; these are encoded whole."""
        found = [np.flatnonzero((data[:-1] == lead) & np.isin(data[1:], second))
                 for lead, second in _WIDE_WHITE.items()]
        found = np.concatenate(found)
        if not len(found):
            return None
        odd = np.zeros(len(offsets) - 1, bool)
        odd[np.searchsorted(offsets, found, "right") - 1] = True
        return odd


def encoder(path: str, keep_white: bool) -> Encoder:
    """The worker's encoder for this file, loaded once."""
    key = (path, keep_white)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, keep_white)
    return _ENCODERS[key]
