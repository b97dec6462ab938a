"""Benchmark decontamination by a CGK embedding, bit-sampling LSH and exact edit distance.

Texts and items are sequences of normalised words. The windows of a document that
have just as many words as an item are compared with it. The CGK random walk reads
a window, writing the word under its cursor ``3 n`` times and moving on by a random
bit of (step, word): sequences of small edit distance come out at a small Hamming
distance. Samples of the output's places are the LSH tables; a window whose sample
equals an item's is a candidate, and candidates are verified by exact word edit
distance. ``walks`` independent walks with ``tables`` samples each reach the target
recall; equal passages always agree.

Before the walk, windows that cannot match are left out without loss: a window
within distance k of any item of n words has at least n - k words of the items'
vocabulary and, as an edit breaks at most two word pairs, n - 1 - 2 k of the items'
adjacent word pairs; pairs of a word with itself count for as many as an item has.

Every document is handled inside one task, items are a broadcast in blocks of at
most ``item_block``, so nothing is shuffled.

Defined results: null and empty texts match nothing, items without words are left
out; a document shorter than an item is compared as one window; repeated rows
give repeated results; of equally near windows the first is reported; extra
columns are not read; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrun.llm import wordbytes as WB
from payrun.llm.shingles import mix

COLUMNS = "doc_id long, item_id long, distance int, start_word int, n_words int, similarity double"
PAD = -1
MEMBER = 4096        # width of the tables of items' words; two words of one place only let more windows through


def term_hashes(words: WB.Words) -> np.ndarray:
    parts = [WB.hashes(words, lo, hi, WB.IS_TERM) for lo, hi in WB.blocks(words)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def step_bits(symbols: np.ndarray, step: int, seed: int) -> np.ndarray:
    """The random bit of each (walk, step, word)."""
    salt = np.uint64((seed * 1_000_003 + step + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix(symbols.astype(np.uint64) + salt) >> np.uint64(63)).astype(np.int64)


def walk(ids: np.ndarray, start: np.ndarray, n: int, places: np.ndarray, seed: int) -> np.ndarray:
    """Words that the walk writes at ``places``, for the windows of n words at ``start``."""
    out = np.empty((len(start), len(places)), np.int64)
    cursor = np.zeros(len(start), np.int64)
    column = {int(p): [] for p in places}
    for i, p in enumerate(places):
        column[int(p)].append(i)
    for step in range(int(places.max()) + 1):
        symbol = np.where(cursor < n, ids[np.minimum(start + cursor, len(ids) - 1)], PAD)
        for i in column.get(step, ()):
            out[:, i] = symbol
        cursor += step_bits(symbol, step, seed)
    return out


def edit_distance(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Word edit distances of the rows of a and b where at most ``most``; more otherwise."""
    p, n = a.shape
    m = b.shape[1]
    far = most + 1
    row = np.minimum(np.arange(m + 1), far).astype(np.int16)[None].repeat(p, 0)
    for i in range(1, n + 1):
        lo, hi = max(1, i - most), min(m, i + most)
        new = np.full((p, m + 1), far, np.int16)
        if i <= most:
            new[:, 0] = i
        for j in range(lo, hi + 1):
            new[:, j] = np.minimum(np.minimum(row[:, j] + 1, new[:, j - 1] + 1), row[:, j - 1] + (a[:, i - 1] != b[:, j - 1]))
        row = np.minimum(new, far)
    return row[:, m]


@dataclass
class ItemIndex:
    """Items by word count, their vocabulary, and the sampled places of each table."""

    vocabulary: np.ndarray                              # sorted word hashes; id is the place plus one
    pairs: np.ndarray                                   # sorted adjacent id pairs of the items
    by_length: dict[int, tuple[np.ndarray, np.ndarray]]   # n: item ids, words (items x n)
    similarity: float
    walks: int
    tables: int
    sampled: int

    @staticmethod
    def build(items: list[tuple[int, str]], similarity: float, walks: int, tables: int, sampled: int) -> "ItemIndex":
        words = WB.split_words([t for _, t in items], WB.IS_TERM)
        vocabulary, ids = np.unique(term_hashes(words), return_inverse=True)
        by_length: dict[int, list] = {}
        for (item_id, _), a, b in zip(items, words.first[:-1], words.first[1:]):
            if b > a:
                by_length.setdefault(int(b - a), []).append((item_id, ids[a:b] + 1))
        pairs = [w[:-1] * (len(vocabulary) + 1) + w[1:] for x in by_length.values() for _, w in x]
        return ItemIndex(vocabulary, np.unique(np.concatenate(pairs or [np.zeros(0, np.int64)])), {n: (np.array([i for i, _ in x]), np.stack([w for _, w in x]).astype(np.int64))
                                      for n, x in sorted(by_length.items())}, similarity, walks, tables, sampled)

    def allowed(self, n: int) -> int:
        """The most edits of an item of n words."""
        return int((1 - self.similarity) * n + 1e-9)

    def places(self, n: int, turn: int) -> np.ndarray:
        """Sampled places (tables x sampled) of one walk over items of n words."""
        rng = np.random.default_rng(1000 * n + turn)
        return rng.integers(0, 3 * n, (self.tables, self.sampled))

    def item_keys(self, n: int, turn: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each table, the sorted keys of the items of n words and their order; kept
        in the task's process once made."""
        kept = self.__dict__.setdefault("_keys", {})
        if (n, turn) not in kept:
            words, places = self.by_length[n][1], self.places(n, turn)
            out = walk(words.ravel(), np.arange(len(words)) * n, n, places.ravel(), turn).reshape(len(words), *places.shape)
            keys = [fold(out[:, t]) for t in range(self.tables)]
            kept[n, turn] = [(np.sort(key, kind="stable"), np.argsort(key, kind="stable")) for key in keys]
        return kept[n, turn]

    def candidates(self, ids: np.ndarray, start: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs that agree in some table of some walk."""
        words, found = self.by_length[n][1], []
        for turn in range(self.walks):
            places = self.places(n, turn)
            ours = walk(ids, start, n, places.ravel(), turn).reshape(len(start), *places.shape)
            for t, (item_key, order) in enumerate(self.item_keys(n, turn)):
                key = fold(ours[:, t])
                lo = np.searchsorted(item_key, key, "left")
                count = np.searchsorted(item_key, key, "right") - lo
                window = np.repeat(np.arange(len(start)), count)
                place = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
                found.append(window * len(words) + order[place])
        pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return pairs // len(words), pairs % len(words)

    def _in_items(self, ids: np.ndarray) -> np.ndarray:
        """Whether each word and the next differ and are adjacent in some item."""
        out = np.zeros(max(0, len(ids) - 1), bool)
        at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0) & (ids[:-1] != ids[1:]))
        if len(at) and len(self.pairs):
            key = ids[at] * (len(self.vocabulary) + 1) + ids[at + 1]
            out[at] = self.pairs[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)] == key
        return out

    def _ids(self, words: WB.Words) -> np.ndarray:
        """The vocabulary's id of each word, 0 of others."""
        hashes = term_hashes(words)
        if not len(hashes) or not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[place] == hashes, place + 1, 0)

    def _windows(self, ids: np.ndarray, words: WB.Words, text_of: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(item length, window length, starts) of the windows that may match."""
        if not ids.any():
            return
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        follow = np.concatenate([[0], np.cumsum(self._in_items(ids))])      # pairs before each word
        count = np.diff(words.first)
        for n, (_, items) in self.by_length.items():
            k = self.allowed(n)
            pairs = n - 1 - 2 * k - int((items[:, 1:] == items[:, :-1]).sum(axis=1).max())
            if len(ids) >= n:
                yield n, n, np.flatnonzero((known[n:] - known[:-n] >= n - k)
                                           & (follow[n - 1:] - follow[:len(ids) - n + 1] >= pairs)
                                           & (text_of[n - 1:] == text_of[:len(ids) - n + 1]))
            for size in range(max(1, n - k), n):            # documents shorter than the item
                start = words.first[:-1][count == size]
                if len(start):
                    start = start[(known[start + size] - known[start] >= n - k)
                                  & (follow[start + size - 1] - follow[start] >= pairs)]
                yield n, size, start

    def possible(self, texts: list[str | None]) -> np.ndarray:
        """Whether a text has a window that may match."""
        words = WB.split_words(texts, WB.IS_TERM)
        text_of, out = np.repeat(np.arange(len(texts)), np.diff(words.first)), np.zeros(len(texts), bool)
        for _, _, start in self._windows(self._ids(words), words, text_of):
            out[text_of[start]] = True
        return out

    def match(self, texts: list[str | None]) -> dict[str, np.ndarray]:
        """Best window of each (text, item) within the allowed edits."""
        words = WB.split_words(texts, WB.IS_TERM)
        ids, text_of = self._ids(words), np.repeat(np.arange(len(texts)), np.diff(words.first))
        out: list[tuple[np.ndarray, ...]] = []
        for n, size, start in self._windows(ids, words, text_of):
            item_ids, items = self.by_length[n]
            self._verify(ids, start, size, n, items, item_ids, self.allowed(n), text_of, words.first, out)
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 5
        order = np.lexsort((cols[3], cols[2], cols[1], cols[0]))
        cols = [c[order] for c in cols]
        best = np.ones(len(order), bool)
        best[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])
        return dict(zip(("text", "item_id", "distance", "start", "n"), (c[best] for c in cols)))

    def _verify(self, ids, start, size, n, items, item_ids, k, text_of, first, out, block: int = 20_000) -> None:
        if not len(start):
            return
        member = np.zeros((len(items), MEMBER), bool)
        member[np.repeat(np.arange(len(items)), n), items.ravel() % MEMBER] = True
        for at in range(0, len(start), block):
            part = start[at:at + block]
            if size == n:
                window, item = self.candidates(ids, part, n)
            else:                                               # whole short texts: every item of n words
                window, item = (x.ravel() for x in np.meshgrid(np.arange(len(part)), np.arange(len(items)), indexing="ij"))
            for a in range(0, len(window), block):
                w, x = part[window[a:a + block]], item[a:a + block]
                text = ids[w[:, None] + np.arange(size)]
                shared = member[x[:, None], text % MEMBER].sum(axis=1) >= n - k     # without loss: words of that item
                w, x, text = w[shared], x[shared], text[shared]
                distance = edit_distance(text, items[x], k)
                near = distance <= k
                if near.any():
                    w, x = w[near], x[near]
                    out.append((text_of[w], item_ids[x], distance[near], w - first[text_of[w]], np.full(len(w), n)))


def fold(samples: np.ndarray) -> np.ndarray:
    key = np.zeros(len(samples), np.uint64)
    for i in range(samples.shape[1]):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + samples[:, i].astype(np.uint64))
    return key


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, walks: int = 4, tables: int = 16,
                 sampled: int = 2, item_block: int = 20_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Best matching window of each (document, item) with a word edit distance of at
    most ``(1 - similarity)`` times the item's words.

    The benchmark is read in blocks of at most about ``item_block`` items, each a
    broadcast; more items mean more passes over the documents.
    """
    spark = docs.sparkSession
    items = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), benchmark["text"].alias("text")).where("text is not null")
    blocks = max(1, -(-items.count() // item_block))
    found = None
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", F.lit("block")), F.lit(blocks)) == b).collect() if blocks > 1 else items.collect()
        index = spark.sparkContext.broadcast(ItemIndex.build(sorted((r["item_id"], r["text"]) for r in rows if r["item_id"] is not None),
                                                             similarity, walks, tables, sampled))
        part = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(scan(index), COLUMNS)
        found = part if found is None else found.union(part)
    return found


def scan(index, group_bytes: int = 4 << 20, read_bytes: int = 1 << 20):
    """Matches the texts of a task. About ``read_bytes`` of texts are looked through at a
    time; those with a window that may match are kept and matched, about ``group_bytes`` together."""

    def matched(ids: list, texts: list) -> Iterator[pa.RecordBatch]:
        got = index.value.match(texts)
        if len(got["text"]):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()).take(pa.array(got["text"])), pa.array(got["item_id"], pa.int64()),
                 pa.array(got["distance"], pa.int32()), pa.array(got["start"], pa.int32()), pa.array(got["n"], pa.int32()),
                 pa.array(1 - got["distance"] / got["n"], pa.float64())],
                ["doc_id", "item_id", "distance", "start_word", "n_words", "similarity"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + read_bytes, side="right")))
                part = batch.slice(at, stop - at)
                some = part.column(1).to_pylist()
                for i in np.flatnonzero(index.value.possible(some)):
                    ids.append(part.column(0)[i].as_py())
                    texts.append(some[i])
                    size += int(ends[at + i] - (ends[at + i - 1] if at + i else 0))
                    if size >= group_bytes:
                        yield from matched(ids, texts)
                        ids, texts, size = [], [], 0
                at = stop
        if texts:
            yield from matched(ids, texts)
    return run
