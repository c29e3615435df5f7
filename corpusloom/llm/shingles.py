"""Word shingles of whole texts as sets of 64-bit hashes, computed on byte arrays."""

from __future__ import annotations

import numpy as np

# ASCII white space: everything else belongs to words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**64 - 1, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(base: np.uint64, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64, kept for the next call."""
    known = _powers.get(str(base))
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _powers[str(base)] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def words_and_endings(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of every word of a UTF-8 text, A-Z lower-cased, in order, and its last three bytes as a number.

    Each hash is a polynomial in random byte values, taken from one running sum over the text.
    """
    if not data:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    raw = _LOWER[np.frombuffer(data, np.uint8)]
    word = ~SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], word, [False]))))
    start, end = edges[0::2], edges[1::2]
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _power(_BASE, len(raw)), out=sums[1:])
    value = (sums[end] - sums[start]) * _power(_INVERSE, len(raw))[start]
    ending = raw[end - 1].astype(np.uint32)
    for k in (2, 3):
        inside = end - k >= start
        ending[inside] |= raw[end[inside] - k].astype(np.uint32) << np.uint32(8 * (k - 1))
    return mix(value + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), ending


def word_hashes(data: bytes) -> np.ndarray:
    """The hashes of ``words_and_endings`` alone."""
    return words_and_endings(data)[0]


def shingle_set(data: bytes | None, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text.

    A text with fewer than ``width`` words is one shingle, one without words has none.
    """
    words = word_hashes(data or b"")
    if not len(words):
        return words
    width = min(width, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        total = mix(total + words[k : k + len(total)] * np.uint64(2 * k + 3))
    return np.unique(total)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())
