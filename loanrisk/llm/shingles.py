"""Word shingles of a text as sorted 64-bit hashes."""

from __future__ import annotations

import numpy as np
import xxhash

MOST_WORDS = 200_000
C1, C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    """Word to hash. It forgets all words when it holds `MOST_WORDS`, so its memory is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MOST_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_set(data: bytes, n: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles of `n` words, sorted; with fewer words the whole sequence is one.

    A-Z count as a-z; words end at space, tab, line feed, vertical tab, form feed and carriage
    return, which is how Python splits bytes. No words: an empty set.
    """
    words = data.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(n, len(w))
    last = len(w) - size + 1
    acc = np.full(last, size, dtype=np.uint64)
    for j in range(size):
        acc ^= acc >> np.uint64(29)
        acc *= C1
        acc += w[j : j + last]
    acc ^= acc >> np.uint64(32)
    acc *= C2
    acc.sort()
    return acc[np.concatenate(([True], acc[1:] != acc[:-1]))] if last > 1 else acc
