"""Words and pieces of many texts at once: positions and 64-bit hashes over Arrow string buffers.

Texts of a batch lie one after another in one UTF-8 buffer. Spans are pairs of byte positions; their hashes come
from one running polynomial modulo 2^64, so no word becomes a Python object. Two different words get equal
hashes with a chance of about 2^-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
_BASE, _LENGTH, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_powers = np.ones(1, np.uint64)
_inverse = np.ones(1, np.uint64)

# Bytes of the words of the corpus contract: anything but space and the controls 9 to 13.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _grow(n: int) -> None:
    global _powers, _inverse
    if len(_powers) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        undo = pow(int(_BASE), -1, 1 << 64)
        for name, base in (("_powers", _BASE), ("_inverse", np.uint64(undo))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            globals()[name] = np.multiply.accumulate(steps)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts; nulls count as empty.

    A run holds about `block_bytes`, or one longer text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + block_bytes, "right")) - 1)
        end = min(end, n)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True that stay within a text."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.zeros(n + 1, bool)
    before[1:] = inside
    here = np.zeros(n + 1, bool)
    here[:n] = inside
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(here & (~before | edge))
    ends = np.flatnonzero(before & (~here | edge))
    return starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(data)
    _grow(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=total[1:])
    h = (total[ends] - total[starts]) * _inverse[starts]
    return mix(h ^ ((ends - starts).astype(np.uint64) * _LENGTH))


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE):
    """(starts, ends, hashes, first word of each text): text i has the words first[i] to first[i + 1]."""
    starts, ends = spans(~space[data], offsets)
    return starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, first: np.ndarray, n: int):
    """(hashes of n consecutive words, index of their first word); no gram crosses texts."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = out * _BASE + hashes[k:k + count]
    whole = np.ones(count, bool)
    for k in range(1, n):
        edges = first - k
        whole[edges[(edges >= 0) & (edges < count)]] = False
    at = np.flatnonzero(whole)
    return mix(out[at]), at


class HashIndex:
    """64-bit keys to small integers by open addressing; grows by `add`, looked up for whole arrays."""

    def __init__(self, bits: int = 21):
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, -1, np.int32)
        self.size = 0

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The value of each hash, -1 where absent."""
        slot = (hashes & self.mask).astype(np.int64)
        out = self.values[slot]
        todo = np.flatnonzero((out >= 0) & (self.keys[slot] != hashes))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & int(self.mask)
            at = slot[todo]
            out[todo] = self.values[at]
            todo = todo[(out[todo] >= 0) & (self.keys[at] != hashes[todo])]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Distinct hashes that are not yet held get the next integers, in order."""
        value = np.arange(self.size, self.size + len(hashes), dtype=np.int32)
        self.size += len(hashes)
        slot = (hashes & self.mask).astype(np.int64)
        todo = np.arange(len(hashes))
        while len(todo):
            free = todo[self.values[slot[todo]] < 0]
            # Of several new keys for one free slot, the last one written holds it.
            self.values[slot[free]] = value[free]
            self.keys[slot[free]] = hashes[free]
            todo = todo[self.values[slot[todo]] != value[todo]]
            slot[todo] = (slot[todo] + 1) & int(self.mask)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... for each pair, one after another."""
    total = int(counts.sum())
    out = np.arange(total, dtype=np.int64)
    return out + np.repeat(starts - (np.cumsum(counts) - counts), counts)
