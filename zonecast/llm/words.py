"""Words of whole texts inside tasks: splitting, hashing, windows.

A word is a run of characters other than space and the control characters 9 to 13, as ``bytes.split`` cuts UTF-8.
"""

from __future__ import annotations

import numpy as np
import xxhash

KEPT = 200_000


class WordHashes(dict):
    """64-bit hash of every word; one table for each Python worker, emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_hashes = WordHashes()


def words(text: str, lower: bool = True) -> list[bytes]:
    raw = text.encode()
    return raw.lower().split() if lower else raw.split()


def hashes(of: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, of), np.uint64, len(of))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words, in order; empty if there are fewer words."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(h) - n + 1, np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[j : j + len(out)]
    return mixed(out)
