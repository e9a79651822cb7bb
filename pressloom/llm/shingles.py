"""Word shingles as 64-bit numbers, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """Word to 64-bit hash; forgets all once it holds ``limit`` words, so its memory is bounded."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def split_lower(text: bytes | None) -> list[bytes]:
    """Blank-separated words with A-Z lower-cased; ``bytes`` methods touch ASCII only."""
    return [] if text is None else text.lower().split()


def shingle_set(words: list[bytes], size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct shingles; fewer words than ``size`` make one shingle, none make none."""
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    k = min(size, n)
    acc = h[:n - k + 1] + np.uint64(k)
    for i in range(1, k):
        acc = acc * _P + h[i:n - k + 1 + i]
    return np.unique(mix(acc))
