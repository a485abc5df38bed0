"""Word shingles of whole texts as 64-bit hashes, computed for many texts at once.

A word is a maximal run of bytes outside space, tab, LF, VT, FF and CR, after lower-casing A-Z. Words are hashed from prefix
sums of a polynomial over the bytes, so no word becomes a Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tidewheel.llm.common import CACHES, slices

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_STEP = np.array([pow(0xD6E8FEB86659FD93, k + 1, 1 << 64) for k in range(64)], np.uint64)
#: Bytes of text that are worked on at once.
CHUNK = 1 << 19
_powers: list[np.ndarray] = []
CACHES["powers"] = _powers.clear


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK) + 1
        _powers[:] = [np.concatenate((np.ones(1, np.uint64), np.multiply.accumulate(np.full(size, b, np.uint64)))) for b in (_BASE, _BACK)]
    return _powers


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of consecutive texts, and for each text the index of its first word (one more at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[0] = edge[n] = True
    fresh = np.ones(n, bool)
    fresh[1:] = ~inside[:-1]
    last = np.ones(n, bool)
    last[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (fresh | edge[:n]))
    ends = np.flatnonzero(inside & (last | edge[1:])) + 1
    up, down = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data] + np.uint64(1)) * up[:n], out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    return words, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of `width` words; fewer words make one shingle, none an empty set."""
    for first, last in slices(offsets, CHUNK):
        at = offsets[first : last + 1]
        words, begin = word_hashes(data[at[0] : at[-1]], at - at[0])
        rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width if len(rolled) else 0):
            rolled += words[k : k + len(rolled)] * _STEP[k]
        rolled = mix(rolled + np.uint64(width))
        for a, b in zip(begin[:-1].tolist(), begin[1:].tolist(), strict=True):
            if b - a >= width:
                yield np.unique(rolled[a : b - width + 1])
            elif b > a:
                yield mix((words[a:b] * _STEP[: b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def set_id(hashes: np.ndarray) -> int:
    """A 64-bit identifier of a set of hashes, signed."""
    total = mix(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(hashes)))
    return int(total.view(np.int64)[0])
