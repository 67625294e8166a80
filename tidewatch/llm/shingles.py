"""Word shingles of many texts at once, as 64-bit hashes in numpy.

Words are runs of bytes other than space and the controls 9 to 13, with A-Z
lower-cased; a word's hash is a polynomial over random 64-bit byte values,
taken from one running sum over the whole batch.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(0x5EED)
_VALUE = _RNG.integers(1, 1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]  # A-Z as a-z
_GAP = np.zeros(256, dtype=bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_PLACE = _RNG.integers(1, 1 << 63, size=16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """Scatter 64 bits (uint64 arithmetic wraps)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.ones(size, dtype=np.uint64)
            p[1:] = np.uint64(base)
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and the number of words of each text."""
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    gap = _GAP[data]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[::2], edge[1::2]
    up, down = _powers(len(data) + 1)
    run = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_VALUE[data] * up[:-1], out=run[1:])
    words = mix((run[end] - run[start]) * down[start])
    stops = np.cumsum([len(r) + 1 for r in raw])
    return words, np.diff(np.searchsorted(start, np.concatenate([[0], stops])))


def shingle_sets(texts: list[str], width: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after the other, and the size of each set.

    A text with fewer than ``width`` words (but any) has its whole sequence as
    its only shingle."""
    words, n = word_hashes(texts)
    owner = np.repeat(np.arange(len(texts)), n)
    k = max(0, len(words) - width + 1)
    h = np.zeros(k, dtype=np.uint64)
    for j in range(width):
        h += words[j:j + k] * _PLACE[j]
    inside = owner[:k] == owner[width - 1:width - 1 + k]
    h, who = mix(h[inside]), owner[:k][inside]
    short = np.flatnonzero((n > 0) & (n < width))
    if len(short):
        first = np.cumsum(n) - n
        extra = np.zeros(len(short), dtype=np.uint64)
        for j in range(width - 1):
            has = n[short] > j
            extra[has] += words[first[short[has]] + j] * _PLACE[8 + j]
        h, who = np.concatenate([h, mix(extra)]), np.concatenate([who, short])
        order = np.argsort(who, kind="stable")
        h, who = h[order], who[order]
    bounds = np.searchsorted(who, np.arange(len(texts) + 1))
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        h[lo:hi].sort()
    if len(h):
        keep = np.ones(len(h), dtype=bool)
        keep[1:] = (h[1:] != h[:-1]) | (who[1:] != who[:-1])
        h, who = h[keep], who[keep]
    return h, np.bincount(who, minlength=len(texts))
