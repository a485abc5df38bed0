"""Letter words of whole texts and 64-bit hashes of them and of their beginnings, for many texts at once."""

from __future__ import annotations

import numpy as np

from tidewheel.llm.shingles import _LOWER, _power_tables, mix

#: Bytes of a word: ASCII letters and every byte of a character beyond ASCII.
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: Lengths in bytes of the beginnings that stand for word stems.
STEMS = (4, 5, 6)


class Words:
    """Words of consecutive texts, lower-cased in A-Z. `text` has the index of each word's text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        inside = _LETTER[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.concatenate(([False], inside[:-1])) if n else inside
        after = np.concatenate((inside[1:], [False])) if n else inside
        self.starts = np.flatnonzero(inside & (~before | edge[:n]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        up, self._down = _power_tables(n)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_LOWER[data] + np.uint64(1)) * up[:n], out=self._sums[1:])
        self.text = np.searchsorted(offsets, self.starts, "right") - 1

    def _hash(self, starts: np.ndarray, ends: np.ndarray, kind: int) -> np.ndarray:
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts] + np.uint64(kind * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))

    def features(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """(hashes, index of the text) of the words and of each length of stem; longer words only have stems."""
        found = [(self._hash(self.starts, self.ends, 1), self.text)]
        for size in STEMS:
            longer = self.ends - self.starts > size
            starts = self.starts[longer]
            found.append((self._hash(starts, starts + size, size), self.text[longer]))
        return found
