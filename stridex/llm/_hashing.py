"""Vectorised string hashing: polynomial hashes modulo 2**64 over byte arrays, mixed at the end."""
from __future__ import annotations

import numpy as np

from ._common import ship_by_value, worker_cache

ship_by_value(__name__)

_BASE = 0x9E3779B97F4A7C15 | 1


def _tables(n: int):
    """Random odd value per byte, powers of the base and of its inverse (at least ``n`` of each)."""
    cache = worker_cache()
    have = cache.get("hash-tables")
    if have is None or len(have[1]) < n:
        size = 1 << max(21, int(n).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        byte = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        up, down = (np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)]) for b in (_BASE, inverse))
        have = cache["hash-tables"] = (byte, up, down)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over the word (splitmix finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashes:
    """Hashes of any stretches of a sequence of bytes (or of 64-bit symbols) after one cumulative pass."""

    def __init__(self, seq: np.ndarray):
        byte, self.up, self.down = _tables(len(seq) + 1)
        value = byte[seq] if seq.dtype == np.uint8 else seq
        self.sum = np.zeros(len(seq) + 1, np.uint64)
        np.cumsum(value * self.up[:len(seq)], out=self.sum[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Hash of seq[start:stop] for arrays of bounds; it depends on the stretch alone."""
        return mix((self.sum[stop] - self.sum[start]) * self.down[start] + (stop - start).astype(np.uint64))

    def every(self, n: int) -> np.ndarray:
        """Hash of every stretch of ``n``."""
        k = len(self.sum) - n
        return mix((self.sum[n:] - self.sum[:k]) * self.down[:k] + np.uint64(n)) if k > 0 else np.zeros(0, np.uint64)


def words_of(buf: np.ndarray, blank: np.ndarray):
    """(hash, start, stop) of the words of a byte array; ``blank``: 256 flags of the bytes between words."""
    gap = blank[buf]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], gap, [True]]).astype(np.int8)))
    start, stop = edge[::2], edge[1::2]
    return Hashes(buf).of(start, stop), start, stop


def sliding_argmin(key: np.ndarray, width: int) -> np.ndarray:
    """Position of the least key (the first of equals) in every window of ``width``; keys lose their lowest 21 bits."""
    low = np.uint64((1 << 21) - 1)
    m = (key & ~low) | np.arange(len(key), dtype=np.uint64)
    span = 1
    while span * 2 <= width and len(m) > span:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    if span < width:
        m = np.minimum(m[:len(m) - (width - span)], m[width - span:]) if len(m) > width - span else m[:0]
    return (m & low).astype(np.int64)
