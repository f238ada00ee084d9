"""CRC-32 of id sequences, and of sequences known only by the CRCs of their parts."""

from __future__ import annotations

import zlib

import numpy as np

_CRC_POLY = 0xEDB88320  # fixed value: the reflected CRC-32 polynomial


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))


def _apply(matrix: list[int], vector: int) -> int:
    out, k = 0, 0
    while vector:
        if vector & 1:
            out ^= matrix[k]
        vector >>= 1
        k += 1
    return out


def _zero_byte_powers() -> list[list[int]]:
    """Operators that append 1, 2, 4, ... zero bytes to a CRC register, as matrices over GF(2)."""
    bit = [_CRC_POLY] + [1 << k for k in range(31)]
    for _ in range(3):
        bit = [_apply(bit, row) for row in bit]
    out = [bit]
    for _ in range(47):
        out.append([_apply(out[-1], row) for row in out[-1]])
    return out


_ZEROS = _zero_byte_powers()


def joined_crc32(first: int, second: int, second_bytes: int) -> int:
    """The CRC of two byte strings one after the other."""
    k = 0
    while second_bytes:
        if second_bytes & 1:
            first = _apply(_ZEROS[k], first)
        second_bytes >>= 1
        k += 1
    return first ^ second
