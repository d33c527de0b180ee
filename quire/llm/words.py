"""Words, word hashes and word n-gram hashes for tasks that work on Arrow batches.

A word is a maximal run of letters and digits, case ignored. All hashes are 64 bits and the
same in every process.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\W_]+")
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


class _Hashes(dict):
    """word -> hash; emptied when full, so a worker's memory stays bounded."""

    LIMIT = 400_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _Hashes()


def words(text: str | None) -> list[str]:
    """The words of a text in order; none for null."""
    return WORD.findall(text.lower()) if text else []


def word_hashes(text: str | None) -> np.ndarray:
    """The hashes of a text's words in order."""
    found = words(text)
    return np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))


def extend_grams(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """Hashes of grams that join the gram of any length at i with the one of ``size`` words after it."""
    power = np.uint64(pow(_BASE, size, _MASK + 1))
    return left[: len(right)] * power + right


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive words; empty if there are fewer words."""
    if len(hashes) < n:
        return hashes[:0]
    out = hashes
    for i in range(1, n):
        out = extend_grams(out, hashes[i:], 1)
    return out


def mixed(values: np.ndarray) -> np.ndarray:
    """The values with their bits well spread (a 64-bit finaliser)."""
    x = values.copy()
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
