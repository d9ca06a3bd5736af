"""Hashes of all spans of a sequence from prefix sums, and small helpers for ragged NumPy arrays."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=2)
def _powers(size: int, base: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _power_table(n: int, base: int) -> np.ndarray:
    return _powers(1 << max(16, int(n).bit_length()), base)


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """Sums of mixed codes times powers of BASE, from 0 on; differences are hashes of spans."""
    x = (codes + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x = (x ^ (x >> np.uint64(31))) * _power_table(len(codes), BASE)[: len(codes)]
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)])


def span_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans; equal spans have equal hashes wherever they are."""
    x = (sums[end] - sums[start]) * _power_table(len(sums), pow(BASE, -1, 1 << 64))[start]
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of many slices, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(int(ends[-1]) if len(ends) else 0)


def finish(x: np.ndarray) -> np.ndarray:
    """Mix the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts with a space after each, first and last places of their words, and words per text."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    inside = ~space
    before = np.concatenate([[True], space[:-1]])
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(space & np.concatenate([[False], inside[:-1]]))
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    first = np.cumsum(lengths) - lengths
    bounds = np.searchsorted(start, np.append(first, len(data)))
    return data, start, end, np.diff(bounds)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each word of all texts, one after the other, and words per text."""
    data, start, end, counts = word_spans(texts)
    return span_hashes(prefix_sums(data.astype(np.uint64)), start, end), counts
