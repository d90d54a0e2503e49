"""Words, shingle sets and MinHash signatures as numpy arrays."""

from __future__ import annotations

import functools

import numpy as np
import xxhash

from .vocabularies import Cache

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_word_hashes = Cache(xxhash.xxh3_64_intdigest)


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers without visible structure."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased: what bytes.split and bytes.lower do."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(_word_hashes.__getitem__, words), np.uint64, len(words))
    _word_hashes.trim()
    return hashes


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; fewer words are one shingle, none is the empty set."""
    w = word_hashes(text)
    if not len(w):
        return w
    n, k = len(w), min(width, len(w))
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = mixed(h * _STEP + w[i : n - k + 1 + i])
    return np.unique(h)


@functools.lru_cache(maxsize=4)
def _functions(count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    x = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * _STEP + np.uint64(seed))
    return x[:count], x[count:] | np.uint64(1)


def signature(shingles: np.ndarray, count: int) -> np.ndarray:
    """``count`` 32-bit MinHash values of a non-empty set."""
    flip, times = _functions(count)
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 512):  # small enough for the processor's cache
        np.minimum(least, ((shingles[start : start + 512, None] ^ flip) * times).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)
