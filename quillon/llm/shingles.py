"""Sets of five-word shingles as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
#: Words whose hashes a worker keeps: about 20 MB.
MOST_WORDS = 100_000
_K = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Hashes of words, kept for words seen before; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > MOST_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


HASHES = WordHashes()


def scrambled(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that leaves no pattern (the finish of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased: what bytes.lower() and bytes.split() do."""
    return (text or b"").lower().split()


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct hashes; the whole sequence as one where there are fewer than five words."""
    ws = words_of(text)
    if not ws:
        return np.zeros(0, np.uint64)
    h = HASHES.of(ws)
    n = min(WORDS, len(h))
    x = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        x = x * _K + h[i : len(h) - n + 1 + i]
    x = scrambled(x)
    x.sort()
    if len(x) > 1:
        x = x[np.concatenate([[True], x[1:] != x[:-1]])]
    return x
