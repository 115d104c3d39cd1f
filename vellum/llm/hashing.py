"""Vectorised 64-bit hashes of byte slices and of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from vellum.llm.common import row_slices, utf8_rows

_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            step = np.full(n, base, np.uint64)
            step[0] = 1
            _POWERS[i] = np.cumprod(step)
    return _POWERS[0][:n], _POWERS[1][:n]


def slice_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each byte slice, from one running sum."""
    up, down = _powers(len(flat) + 1)
    total = np.zeros(len(flat) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[flat] * up[: len(flat)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    h ^= (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return h


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_hashes(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z) and the bounds of each row's words."""
    n = len(flat)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    word = ~_IS_SPACE[flat]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.append(False, word[:-1]) & ~edge[:-1]
    starts = np.flatnonzero(word & ~before)
    after = np.append(word[1:], False) & ~edge[1:]
    ends = np.flatnonzero(word & ~after) + 1
    return mixed(slice_hashes(_LOWER[flat], starts, ends)), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of ``size`` words and each row's bounds; a shorter row of words is one shingle."""
    count = np.diff(bounds)
    pieces = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    out_bounds = np.append(0, np.cumsum(pieces))
    rows = np.repeat(np.arange(len(count)), pieces)
    at = np.arange(out_bounds[-1]) - out_bounds[rows] + bounds[rows]
    length = np.minimum(count[rows], size)
    h = mixed(words[at] + length.astype(np.uint64)) if len(at) else np.zeros(0, np.uint64)
    for k in range(1, size):
        longer = length > k
        if longer.all():
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + words[at + k])
        else:
            some = np.flatnonzero(longer)
            h[some] = mixed(h[some] * np.uint64(0x9E3779B97F4A7C15) + words[at[some] + k])
    return h, out_bounds


def shingle_sets(column: pa.Array, size: int, limit: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, sorted distinct shingle hashes, each row's bounds) for slices of a text column."""
    flat, offsets = utf8_rows(column)
    for a, b in row_slices(offsets, limit):
        words, bounds = word_hashes(flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        h, bounds = shingle_hashes(words, bounds, size)
        sets = [np.unique(h[x:y]) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        yield a, b, np.concatenate([np.zeros(0, np.uint64), *sets]), np.append(0, np.cumsum([len(s) for s in sets]))
