"""Words of many texts at once, as slices of one UTF-8 byte array."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bytes of words: lower-case letters and every byte of a character beyond ASCII.
IS_WORD = np.zeros(256, bool)
IS_WORD[ord("a"):ord("z") + 1] = True
IS_WORD[128:] = True

#: Script by lead byte: ASCII, Latin with marks, Greek, Cyrillic, Armenian and
#: Hebrew, Arabic and Syriac, Indic and Thai, E1 blocks, symbols, kana, Han, Hangul, beyond.
SCRIPT = np.zeros(256, np.uint8)
for code, first, last in ((1, 0xC2, 0xCB), (2, 0xCC, 0xCF), (3, 0xD0, 0xD3), (4, 0xD4, 0xD7), (5, 0xD8, 0xDF),
                          (6, 0xE0, 0xE0), (7, 0xE1, 0xE1), (8, 0xE2, 0xE2), (9, 0xE3, 0xE3), (10, 0xE4, 0xE9),
                          (11, 0xEA, 0xED), (12, 0xEE, 0xFF)):
    SCRIPT[first:last + 1] = code
N_SCRIPTS = 13


@dataclass
class Words:
    """``starts`` and ``ends`` in ``data``; the words of text i are those from
    ``first[i]`` up to ``first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


#: The same with digits.
IS_TERM = IS_WORD.copy()
IS_TERM[ord("0"):ord("9") + 1] = True

POWERS = (np.uint64(0x9E3779B97F4A7C15) ** np.arange(1, 65, dtype=np.uint64)).astype(np.uint64)


def split_words(texts: list[str | None], kind: np.ndarray = IS_WORD) -> Words:
    """Lower-case words; null counts as empty. Texts never share a word."""
    parts = [(t or "").lower().encode() for t in texts]
    data = np.frombuffer(b"\n" + b"\n".join(parts) + b"\n", np.uint8)
    inside = kind[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    offsets = np.cumsum([1, *(len(p) + 1 for p in parts)])
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def blocks(words: Words, size: int = 1 << 20):
    """Ranges of words that cover about ``size`` bytes each (or one long word)."""
    at, n = 0, len(words.starts)
    while at < n:
        stop = max(at + 1, int(np.searchsorted(words.ends, words.starts[at] + size, side="right")))
        yield at, stop
        at = stop


def trigrams(words: Words, lo: int, hi: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams centred on each byte of words lo..hi, with word edges
    as a byte of their own, and where each word begins among them."""
    a, b = int(words.starts[lo]), int(words.ends[hi - 1])
    data = words.data[a - 1:b + 1]
    inside = IS_WORD[data]
    code = np.where(inside, data, 0).astype(np.uint32)
    mixed = code[:-2] * np.uint32(0x9E3779B1) + code[1:-1] * np.uint32(0x85EBCA6B) + code[2:] * np.uint32(0xC2B2AE35)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    grams = (mixed >> np.uint32(32 - bits))[inside[1:-1]]
    lengths = (words.ends[lo:hi] - words.starts[lo:hi]).astype(np.int64)
    return grams, np.concatenate([[0], np.cumsum(lengths[:-1])])


def scripts(words: Words, lo: int, hi: int) -> np.ndarray:
    """The highest script code of each word."""
    a, b = int(words.starts[lo]), int(words.ends[hi - 1])
    data = words.data[a:b]
    inside = IS_WORD[data]
    lengths = words.ends[lo:hi] - words.starts[lo:hi]
    return np.maximum.reduceat(SCRIPT[data][inside], np.concatenate([[0], np.cumsum(lengths[:-1])]))


def hashes(words: Words, lo: int, hi: int, kind: np.ndarray = IS_WORD) -> np.ndarray:
    """64-bit hashes of words lo..hi."""
    a, b = int(words.starts[lo]), int(words.ends[hi - 1])
    data = words.data[a:b]
    letters = data[kind[data]].astype(np.uint64)
    length = words.ends[lo:hi] - words.starts[lo:hi]
    begin = np.cumsum(length) - length
    place = (np.arange(len(letters)) - np.repeat(begin, length)) & 63
    mixed = np.add.reduceat(letters * POWERS[place], begin)
    mixed ^= mixed >> np.uint64(29)
    return mixed * np.uint64(0xBF58476D1CE4E5B9)
