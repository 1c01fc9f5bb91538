"""Words, their hashes and the runs of words that several operators of this folder compare."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words; forgets them all when there are ``limit``."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word):
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value

    def of(self, words: list) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def normal_words(text: str) -> list[str]:
    """Runs of letters, digits and underscores in lower case."""
    return WORD.findall(text.lower())


def run_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of ``length`` words; none if there are fewer."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(length):
        total = total * _PRIME + words[i : i + n]
    return mixed(total)
