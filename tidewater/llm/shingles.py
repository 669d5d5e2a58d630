"""Sets of word shingles as sorted 64-bit hashes, computed on a text's bytes by numpy.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  A word's hash is a
polynomial over 64-bit values of its bytes, taken from prefix sums; a shingle's
mixes those of its words in order.
"""

from __future__ import annotations

import numpy as np

MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C17 | 3  # odd, and one less is twice an odd number
_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 1 << 63, size=256, dtype=np.uint64) | np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]  # A-Z as a-z
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_PLACE = tuple(np.uint64(x) for x in _rng.integers(1, 1 << 63, size=64, dtype=np.uint64) | np.uint64(1))
_POWERS: list[np.ndarray] = []


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> list[np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (at least)."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = 1 << max(14, (n - 1).bit_length())
        del _POWERS[:]
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            out, done = np.ones(size, dtype=np.uint64), 1
            while done < size:
                out[done : 2 * done] = out[:done] * np.uint64(pow(base, done, 1 << 64))
                done *= 2
            _POWERS.append(out)
    return _POWERS


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the text's words, in order."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(b):
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(len(b) + 1)
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = ~_BLANK[b]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[b] * up[: len(b)], out=sums[1:])
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_set(text: str | None, size: int = 3) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer words than ``size`` are one shingle, none give an empty set."""
    w = word_hashes(text) if text else np.zeros(0, dtype=np.uint64)
    if not len(w):
        return w
    k = min(size, len(w))
    count = len(w) - k + 1
    total = np.full(count, np.uint64(k))
    for j in range(k):
        total += w[j : j + count] * _PLACE[j]
    return np.unique(mix64(total))
