"""Rolling (Rabin-Karp) hashes of word sequences, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_CACHE_WORDS = 1 << 18
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


class WordHashes(dict):
    """Word -> 64-bit hash; emptied when it holds too many words."""

    def __missing__(self, word: bytes | str) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word, 1)
        return value

    def array(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def rolling_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash (modulo 2 ** 64, then mixed) of every ``width`` consecutive word hashes."""
    n = len(words)
    if n < width or not n:
        return np.empty(0, np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.add.accumulate(words * _powers(_BASE, n))])
    return mix((sums[width:] - sums[:-width]) * _powers(_BASE_INVERSE, n - width + 1))
