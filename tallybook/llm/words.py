"""Word hashes and occurrence-labelled word shingles (numpy, inside tasks)."""

from __future__ import annotations

import string

import numpy as np
import xxhash

#: entries a worker's word cache holds before it is emptied (bounds its memory)
CACHE_WORDS = 150_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


class WordHashes(dict):
    """word -> 64-bit hash of the word in lower case without outer punctuation."""

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = xxhash.xxh64_intdigest(word.lower().strip(string.punctuation) or word)
        self[word] = value
        return value


_CACHE = WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the white-space separated words of a whole text (null: none)."""
    words = (text or "").split()
    return np.fromiter(map(_CACHE.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(31))) * _ODD[4]
    x = (x ^ (x >> np.uint64(29))) * _ODD[5]
    return x ^ (x >> np.uint64(32))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of ``size`` words; fewer words make one shingle of all."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    out = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        out = (out ^ hashes[k:n - size + 1 + k]) * _ODD[k % 8] + np.uint64(k + 1)
    return mix(out)


def labelled(values: np.ndarray) -> np.ndarray:
    """Mark the c-th occurrence of a value with c, which makes all distinct."""
    n = len(values)
    if n < 2:
        return values
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    same = np.empty(n, bool)
    same[0] = False
    np.equal(ranked[1:], ranked[:-1], out=same[1:])
    if not same.any():
        return values
    at = np.arange(n)
    occurrence = at - np.maximum.accumulate(np.where(same, 0, at))
    out = values.copy()
    out[order] = ranked ^ mix(occurrence.astype(np.uint64) * _ODD[6])
    return out
