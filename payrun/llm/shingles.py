"""Word-shingle sets as sorted 64-bit hashes, and their b-bit minhash signatures."""

from __future__ import annotations

import numpy as np
import xxhash

MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


class WordHashes:
    """64-bit hashes of words; a bounded memory of the last ones spares repeats."""

    def __init__(self, most: int = 200_000):
        self.known: dict[bytes, int] = {}
        self.most = most

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return (text or "").encode().lower().split()


def shingle_set(words: list[bytes], n: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``n``-word shingles; fewer words are one
    shingle, no words an empty set."""
    if not words:
        return np.zeros(0, np.uint64)
    h = hashes(words)
    n = min(n, len(h))
    total = h[:len(h) - n + 1].copy()
    for i in range(1, n):
        total = mix(total + np.uint64(0x9E3779B97F4A7C15)) + h[i:len(h) - n + 1 + i]
    return np.unique(mix(total))


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """Whether ``den * |a and b| >= num * |a or b|``, on full sets."""
    if not len(a) or not len(b) or den * min(len(a), len(b)) < num * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return den * both >= num * (len(a) + len(b) - both)


class Signer:
    """``size`` components of 8 bits: the low byte of the smallest hash under each
    of ``size`` hash functions."""

    def __init__(self, size: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.times = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = rng.integers(0, 1 << 63, size, dtype=np.uint64)

    def __call__(self, shingles: np.ndarray, block: int = 4096) -> np.ndarray:
        low = np.full(len(self.times), np.iinfo(np.uint64).max, np.uint64)
        for a in range(0, len(shingles), block):
            part = shingles[a:a + block, None] * self.times + self.plus
            np.minimum(low, part.min(axis=0), out=low)
        return (mix(low) & np.uint64(0xFF)).astype(np.uint8)
