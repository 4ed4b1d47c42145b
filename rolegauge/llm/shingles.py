"""Words, five-word shingles and MinHash signatures of whole texts, in numpy.

A word is a maximal run of letters and digits, in lower case. A text with one to four words has one shingle, all its words; a text
without words has none. Shingles are 64-bit hashes; the same text has the same hashes in every process.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WIDTH = 5
WORD = re.compile(r"[^\W_]+")
KNOWN_WORDS = 400_000

# Odd multipliers of the shingle hash, one per place.
FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
SHORT = np.array([0xD6E8FEB86659FD93], np.uint64)


class WordHashes(dict):
    """Hash of a word, computed once; emptied when it has grown too large."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


HASHES = WordHashes()


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def window_hashes(hashes: np.ndarray) -> np.ndarray:
    """A hash for each run of five words, in text order; one for all words of a shorter text."""
    n = len(hashes)
    if n >= WIDTH:
        total = hashes[: n - WIDTH + 1] * FACTORS[0]
        for place in range(1, WIDTH):
            total = total + hashes[place : n - WIDTH + 1 + place] * FACTORS[place]
        return mixed(total)
    if not n:
        return hashes
    return mixed((hashes * FACTORS[:n]).sum(dtype=np.uint64, keepdims=True) + SHORT * np.uint64(n))


def shingles(text: str) -> np.ndarray:
    """The distinct shingles of a text, sorted."""
    return np.unique(window_hashes(word_hashes(words_of(text))))


class MinHasher:
    """Signatures of `size` 32-bit values. Equal places in two signatures estimate the Jaccard similarity of the two sets."""

    def __init__(self, size: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.factors = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.shifts = rng.integers(0, 1 << 63, size, dtype=np.uint64)

    def signatures(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row for each set; `starts` are the places in `values` where the (non-empty) sets begin."""
        found = np.empty((len(starts), len(self.factors)), np.uint32)
        for i, (factor, shift) in enumerate(zip(self.factors, self.shifts, strict=True)):
            found[:, i] = np.minimum.reduceat(((values * factor + shift) >> np.uint64(32)).astype(np.uint32), starts)
        return found


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key for each row and band; the band is part of the key."""
    keys = np.empty((len(signatures), bands), np.int64)
    for band in range(bands):
        total = np.full(len(signatures), band + 1, np.uint64)
        for row in range(rows):
            total = mixed(total * FACTORS[1] + signatures[:, band * rows + row])
        keys[:, band] = total.view(np.int64)
    return keys
