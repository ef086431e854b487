"""Golomb-Rice codes of sorted hashes, and packed bits, in numpy."""

from __future__ import annotations

import struct

import numpy as np

HEAD = struct.Struct("<QBQ")


def rice_encode(values: np.ndarray) -> bytes:
    """Codes a non-decreasing array of uint64: gaps, the quotients in unary and then the remainders in fixed width.

    Both parts stand apart, so that each is read without a loop over the values.
    """
    n = len(values)
    if not n:
        return HEAD.pack(0, 0, 0)
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    width = max(0, int(np.floor(np.log2(max(1.0, float(values[-1]) / n * 0.69)))))
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 1
    head = np.packbits(unary).tobytes()
    rest = gaps & np.uint64((1 << width) - 1)
    bits = np.empty((n, width), np.uint8)
    for j in range(width):
        bits[:, j] = (rest >> np.uint64(j)) & np.uint64(1)
    return HEAD.pack(n, width, len(head)) + head + np.packbits(bits.ravel()).tobytes()


def rice_decode(blob: bytes) -> np.ndarray:
    n, width, size = HEAD.unpack_from(blob)
    if not n:
        return np.empty(0, np.uint64)
    unary = np.unpackbits(np.frombuffer(blob, np.uint8, size, HEAD.size))
    ends = np.flatnonzero(unary)[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(width)
    if width:
        bits = np.unpackbits(np.frombuffer(blob, np.uint8, offset=HEAD.size + size), count=n * width).reshape(n, width)
        for j in range(width):
            gaps |= bits[:, j].astype(np.uint64) << np.uint64(j)
    return np.cumsum(gaps, dtype=np.uint64)


def pack_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags.astype(np.uint8)).tobytes()


def unpack_bits(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(blob, np.uint8), count=n).astype(bool)
