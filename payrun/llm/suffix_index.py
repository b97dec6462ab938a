"""Removal of repeated byte strings with a logarithmic family of sparse suffix arrays.

A text's suffixes are sampled by content: of the ``GRAM``-byte strings inside each
window of ``length`` bytes the one of least hash (the leftmost on a tie) is the
window's anchor, so equal windows have equal anchors at the same place. A suffix array
holds the sampled suffixes in order of their first ``GRAM`` bytes (kept whole, as three
numbers) and, below these, of a hash of all windows around the anchor.

Batches of documents arrive in order of doc_id. The suffixes of a batch are sorted
together with the arrays of the family and read once in that order (the merge scan):
a suffix whose windows all equal those of an earlier one is covered whole; neighbours
with equal first bytes and different surroundings are kept for a comparison of their
texts, window by window. What is new becomes the batch's array; arrays of equal size
are merged before the next batch comes, and the files of superseded ones are deleted,
so there are about log2 of the batches. An array is written only if a batch follows.

Hot strings: suffixes with equal surroundings are combined inside the tasks before the
shuffle; grams with more than ``hot_rows`` different surroundings are compared by one
aggregate over all windows, taken partly before the shuffle. Every repeated window is
found: nothing is capped. Surroundings and windows are told apart by 64-bit hashes
below equal grams.

Defined results: null text counts as empty; texts shorter than ``length`` stay
whole; rows with a null doc_id stay whole; rows repeated under one doc_id are taken
as one document for what is earlier, and each has the same bytes removed if they
have the same text (otherwise, what is covered in either); extra columns are not
read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrun.llm.common import drop_stage, new_path, stage
from payrun.llm.hamming_dedup import runs_of_equal
from payrun.llm.shingles import mix

GRAM = 24                       # three numbers of 8 bytes
PREFIX = ["p1", "p2", "p3"]
ENTRY = "p1 long, p2 long, p3 long, around long, doc_id long, at long"
NAMES = [*PREFIX, "around", "doc_id", "at"]
BASE = 0x9E3779B97F4A7C15
SIGN = np.uint64(1 << 63)       # signed order of the numbers is the order of their bytes
TIMES = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)
BYTE = np.random.default_rng(17).integers(0, 1 << 63, 256, dtype=np.uint64)
COMBINE = 100_000               # suffixes that a task combines at a time, at least
COMPARE = 5_000                 # suffixes whose windows a task compares at a time, at least
PART_BYTES = 64 << 20           # bytes of text behind one partition of an array
BROADCAST_PLACES = 4_000_000    # places to compare that a task may hold as a table (8 bytes each); beyond it, a join by shuffle
BROADCAST_CUTS = 1_000_000      # intervals that a task may hold as a table (about 16 MB); beyond it, a join by shuffle


class Powers:
    """Powers of the hash base and of its inverse modulo 2^64."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> "Powers":
        if len(self.up) < n + 1:
            size = 2 * n + 1
            self.up = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, BASE, np.uint64))])
            inverse = pow(BASE, -1, 1 << 64)
            self.down = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, inverse, np.uint64))])
        return self


def sampled_suffixes(data: np.ndarray, length: int, powers: Powers) -> tuple[np.ndarray, ...]:
    """First bytes (three numbers), windows' hash and packed place of a text's sampled suffixes.

    The place holds the anchor's position and how far its first and last window start before it.
    """
    n = len(data)
    p = powers.upto(n)
    word = data.astype(np.uint64)
    for step in (1, 2, 4):
        word = (word[:-step] << np.uint64(8 * step)) | word[step:]
    m = n - GRAM + 1
    low = word[:m] * TIMES[0] + word[8:8 + m] * TIMES[1] + word[16:16 + m] * TIMES[2]
    low ^= low >> np.uint64(29)
    low *= np.uint64(BASE)
    low &= np.uint64(0xFFFFFFFF00000000)
    low |= np.arange(m, dtype=np.uint64)
    reach, need = 1, length - GRAM + 1
    while reach < need:
        shift = min(reach, need - reach)
        low = np.minimum(low[:-shift], low[shift:])
        reach += shift
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    last = np.concatenate([first[1:], [len(at)]]) - 1
    place = at[first]
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE[data] * p.up[:n])])
    around = mix((prefix[last + length] - prefix[first]) * p.down[first] + (place - first).astype(np.uint64) * np.uint64(BASE)
                 + (last - first).astype(np.uint64))
    numbers = [(word[place + i] ^ SIGN).view(np.int64) for i in (0, 8, 16)]
    return *numbers, around.view(np.int64), (place << 16) | ((place - first) << 8) | (place - last)


def bounds(at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the bytes that the windows of a packed place cover."""
    place = at >> 16
    return place - ((at >> 8) & 255), place - (at & 255) + length


def merged_intervals(doc_id: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping and touching intervals of a document as one."""
    order = np.lexsort((end, start, doc_id))
    doc_id, start, end = doc_id[order], start[order], end[order]
    if not len(start):
        return doc_id, start, end
    owner = np.cumsum(np.concatenate([[0], doc_id[1:] != doc_id[:-1]]))
    wide = int(end.max()) + 1
    reach = np.maximum.accumulate(owner * wide + end) - owner * wide      # of one document: the next begins above it
    cut = np.flatnonzero((owner[1:] != owner[:-1]) | (start[1:] > reach[:-1])) + 1
    first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(start)]]) - 1
    return doc_id[first], start[first], reach[last]


def interval_rows(doc_id: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Intervals in the columns of suffixes: their place is -1, their partition follows the document."""
    doc_id, start, end = merged_intervals(doc_id, start, end)
    return [mix(doc_id.view(np.uint64)).view(np.int64), start, end, np.zeros_like(doc_id), doc_id, np.full_like(doc_id, -1)]


def combined(cols: list[np.ndarray], length: int) -> list[np.ndarray]:
    """Of suffixes with equal surroundings the first; the others as intervals, which they repeat for sure."""
    p1, p2, p3, around, doc_id, at = cols
    key = mix(around.view(np.uint64) + mix(p1.view(np.uint64) ^ mix(p2.view(np.uint64) ^ mix(p3.view(np.uint64)))))
    order = np.lexsort((at, doc_id, key))
    cols = [c[order] for c in cols]
    start = np.ones(len(order), bool)
    start[1:] = np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)
    head = np.flatnonzero(start)[np.cumsum(start) - 1]
    doc_id, at = cols[4:]
    again = (doc_id != doc_id[head]) | (at != at[head])
    rest = interval_rows(doc_id[again], *bounds(at[again], length))
    return [np.concatenate([c[start], r]) for c, r in zip(cols, rest)]


def suffixes(docs: DataFrame, length: int, combine: int = COMBINE) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, parts, held = Powers(), [], 0

        def flush() -> pa.RecordBatch:
            cols = combined([np.concatenate(c) for c in zip(*parts)], length)
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], NAMES)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = np.frombuffer(text.as_buffer() or b"", np.uint8)
                if len(data) >= length:
                    *numbers, around, at = sampled_suffixes(data, length, powers)
                    parts.append((*numbers, around, np.full(len(at), doc_id), at))
                    held += len(at)
                    if held >= combine:
                        yield flush()
                        parts, held = [], 0
        if parts:
            yield flush()

    return docs.mapInArrow(run, ENTRY)


KIND = "kind tinyint"
NEW, MIXED, OLD_MIXED, COVERED = 0, 1, 2, 3


def merge_scan(rows: DataFrame, low: int, length: int) -> DataFrame:
    """Reads sorted suffixes once: ``kind`` tells what a row is.

    NEW and MIXED are first suffixes of the batch, those from doc_id ``low`` on; MIXED and
    OLD_MIXED have a neighbour with equal first bytes and other surroundings; COVERED are intervals.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(cols: list[np.ndarray], kind: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array(kind, pa.int8())], [*NAMES, "kind"])

        def firsts(cols: list[np.ndarray], mixed: np.ndarray) -> pa.RecordBatch:
            new = cols[4] >= low
            keep = new | mixed
            kind = np.where(new, np.where(mixed, MIXED, NEW), OLD_MIXED)[keep]
            return rows_of([c[keep] for c in cols], kind)

        held, held_mixed = None, False          # first suffix of the last run, whose right neighbour is not known yet
        for batch in batches:
            cols = [c.to_numpy() for c in batch.columns]
            ready = cols[5] < 0
            if ready.any():
                yield rows_of([c[ready] for c in cols], np.full(int(ready.sum()), COVERED))
                cols = [c[~ready] for c in cols]
            if held is not None:
                cols = [np.concatenate([h, c]) for h, c in zip(held, cols)]
            if not len(cols[0]):
                continue
            other = np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)
            start = np.concatenate([[True], other | (cols[3][1:] != cols[3][:-1])])
            place = np.flatnonzero(start)
            head = place[np.cumsum(start) - 1]
            doc_id, at = cols[4:]
            again = ((doc_id != doc_id[head]) | (at != at[head])) & (doc_id >= low)
            if again.any():
                rest = interval_rows(doc_id[again], *bounds(at[again], length))
                yield rows_of(rest, np.full(len(rest[0]), COVERED))
            near = ~np.concatenate([[True], other])[place]          # equal first bytes as the run before
            mixed = near.copy()
            mixed[:-1] |= near[1:]
            mixed[0] |= held_mixed
            yield firsts([c[place[:-1]] for c in cols], mixed[:-1])
            held, held_mixed = [c[place[-1:]] for c in cols], bool(mixed[-1])
        if held is not None:
            yield firsts(held, np.array([held_mixed]))

    return rows.mapInArrow(run, f"{ENTRY}, {KIND}")


def with_bytes(rows: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """The bytes of all windows around each suffix of ``rows`` (doc_id, at, new); a text is read once for all of its suffixes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"key": [], "doc_id": [], "pos": [], "lo": [], "new": [], "body": []}
            for doc_id, text, packed in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("at")):
                data, packed = text.as_buffer().to_pybytes(), packed.values.to_numpy()
                at = packed >> 1
                start, end = bounds(at, length)
                fits = end <= len(data)         # rows repeated under one doc_id may have other texts
                at, start, end = at[fits], start[fits], end[fits]
                gram = np.frombuffer(b"".join(data[p:p + GRAM] for p in at >> 16), np.uint64).reshape(-1, 3)
                out["key"].append(mix(gram[:, 0] ^ mix(gram[:, 1] ^ mix(gram[:, 2]))).view(np.int64))
                out["doc_id"].append(np.full(len(at), doc_id))
                out["pos"].append(at >> 16)
                out["lo"].append(start - (at >> 16))
                out["new"].append((packed[fits] & 1).astype(bool))
                out["body"].extend(data[a:b] for a, b in zip(start, end))
            if out["key"]:
                flat = [np.concatenate(out[c]) for c in ("key", "doc_id", "pos", "lo", "new")]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(flat, kinds)), pa.array(out["body"], pa.binary())], list(out))

    by_doc = rows.groupBy("doc_id").agg(F.collect_list(F.col("at") * 2 + F.col("new").cast("long")).alias("at"))
    if rows.count() <= BROADCAST_PLACES:
        by_doc = F.broadcast(by_doc)
    return (docs.join(by_doc, "doc_id").select("doc_id", "text", "at")
            .mapInArrow(run, "key long, doc_id long, pos int, lo int, new boolean, body binary"))


def window_hashes(pdf: pd.DataFrame, length: int, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, offset and hash of every window around the suffixes of ``pdf``."""
    sizes = pdf["body"].str.len().to_numpy()
    data = np.frombuffer(b"".join(pdf["body"]), np.uint8)
    p = powers.upto(len(data))
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE[data] * p.up[:len(data)])])
    count = sizes - length + 1
    row = np.repeat(np.arange(len(pdf)), count)
    rank = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    at = (np.cumsum(sizes) - sizes)[row] + rank
    offset = pdf["lo"].to_numpy()[row] + rank
    return row, offset, mix((prefix[at + length] - prefix[at]) * p.down[at])


def covered(doc_id: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """Runs of neighbouring windows as intervals."""
    order = np.lexsort((start, doc_id))
    doc_id, start = doc_id[order], start[order]
    cut = np.flatnonzero((doc_id[1:] != doc_id[:-1]) | (start[1:] > start[:-1] + 1)) + 1
    first, last = np.concatenate([[0], cut]).astype(int), np.concatenate([cut, [len(start)]]).astype(int) - 1
    if not len(start):
        first = last = np.zeros(0, int)
    return pa.RecordBatch.from_arrays([pa.array(doc_id[first], pa.int64()), pa.array(start[first], pa.int32()),
                                       pa.array(start[last] + length, pa.int32())], ["doc_id", "start", "end"])


INTERVAL = "doc_id long, start int, end int"


class SuffixFamily:
    """Arrays of the batches so far; ``add`` gives the intervals that a batch repeats."""

    def __init__(self, length: int = 100, hot_rows: int = 20_000, partitions: int = 8):
        self.length, self.hot_rows, self.partitions = length, hot_rows, partitions
        self.levels: list[tuple[int, str, DataFrame]] = []
        self.seen: DataFrame | None = None

    def add(self, docs: DataFrame, more: bool = True) -> DataFrame:
        """Intervals (doc_id, start, end) of ``docs`` (doc_id, text) that occur earlier: in an
        earlier batch, a smaller doc_id of this one, or further left. Its doc_ids are greater
        than those before. ``more``: whether another batch may follow, which needs the array."""
        low = docs.agg(F.min("doc_id")).first()[0]
        rows = suffixes(docs, self.length)
        for _, _, level in self.levels:
            rows = rows.union(level)
        scanned = merge_scan(self._ordered(rows), -(1 << 63) if low is None else low, self.length)
        path = new_path(docs.sparkSession, "array")
        scanned.where("true" if more else f"kind <> {NEW}").write.parquet(path)
        scanned = docs.sparkSession.read.schema(scanned.schema).parquet(path)
        self.seen = docs if self.seen is None else self.seen.union(docs)
        found = self._compared(scanned)
        if more:
            self.levels.append((1, path, scanned.where(F.col("kind").isin(NEW, MIXED)).drop("kind")))
            self._merge_levels()
        else:
            drop_stage(docs.sparkSession, path)
        return found

    def _ordered(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.partitions, *PREFIX).sortWithinPartitions(*NAMES)

    def _merge_levels(self) -> None:
        """Levels share no suffix with equal surroundings, so a merge is their union in order."""
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (size, path_a, a), (_, path_b, b) = self.levels.pop(), self.levels.pop()
            spark, path = a.sparkSession, new_path(a.sparkSession, "array")
            self._ordered(a.union(b)).write.parquet(path)
            self.levels.append((2 * size, path, spark.read.schema(ENTRY).parquet(path)))
            drop_stage(spark, path_a)
            drop_stage(spark, path_b)

    def _compared(self, scanned: DataFrame) -> DataFrame:
        length, hot_rows = self.length, self.hot_rows
        whole = scanned.where(F.col("kind") == COVERED).select("doc_id", F.col("p2").cast("int").alias("start"), F.col("p3").cast("int").alias("end"))
        mixed = scanned.where(F.col("kind").isin(MIXED, OLD_MIXED)).select(*PREFIX, "doc_id", "at", (F.col("kind") == MIXED).alias("new"))
        grams = mixed.groupBy(*PREFIX).agg(F.max("new").alias("any_new"), F.count("*").alias("rows"))
        if self.levels:         # grams without a suffix of this batch were compared before
            mixed = mixed.join(grams.where("any_new").select(*PREFIX), PREFIX, "left_semi")
        hot_grams = grams.where((F.col("rows") > hot_rows) & F.col("any_new")).select(*PREFIX)
        cool, hot = mixed, None
        if not hot_grams.isEmpty():
            hot_grams = stage(hot_grams, "hot")
            cool, hot = mixed.join(hot_grams, PREFIX, "left_anti"), mixed.join(hot_grams, PREFIX, "left_semi")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            powers, held = Powers(), []

            def flush() -> pa.RecordBatch:
                pdf = pd.concat(held, ignore_index=True)
                held.clear()
                row, offset, hashed = window_hashes(pdf, length, powers)
                key = mix(hashed ^ mix(pdf["key"].to_numpy().view(np.uint64)[row]) + offset.astype(np.uint64))
                _, index, inverse = np.unique(key, return_index=True, return_inverse=True)
                doc_id, start = pdf["doc_id"].to_numpy()[row], pdf["pos"].to_numpy()[row] + offset
                first = index[inverse]          # rows are in order of (key, doc_id, pos)
                again = pdf["new"].to_numpy()[row] & ((doc_id != doc_id[first]) | (start != start[first]))
                return covered(doc_id[again], start[again], length)

            size = 0
            for group in runs_of_equal(batches, ["key"]):
                held.append(group)
                size += len(group)
                if size >= COMPARE:
                    yield flush()
                    size = 0
            if held:
                yield flush()

        def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            powers = Powers()
            for batch in batches:
                pdf = batch.to_pandas()
                if len(pdf):
                    row, offset, hashed = window_hashes(pdf, length, powers)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashed.view(np.int64)), pa.array(pdf["doc_id"].to_numpy()[row]),
                         pa.array((pdf["pos"].to_numpy()[row] + offset).astype(np.int32)), pa.array(pdf["new"].to_numpy()[row])],
                        ["hash", "doc_id", "start", "new"])

        found = whole.union(with_bytes(cool.drop(*PREFIX), self.seen, length).repartition(self.partitions, "key")
                            .sortWithinPartitions("key", "doc_id", "pos").mapInArrow(compare, INTERVAL))
        if hot is not None:
            places = with_bytes(hot.drop(*PREFIX), self.seen, length).mapInArrow(windows, "hash long, doc_id long, start int, new boolean")
            first = places.groupBy("hash").agg(F.min(F.struct("doc_id", "start")).alias("first"))
            found = found.union(places.join(first, "hash").where(F.col("new") & (F.struct("doc_id", "start") > F.col("first")))
                                .select("doc_id", "start", (F.col("start") + length).alias("end")))
        return stage(found, "intervals")


def batches_of(docs: DataFrame, batches: int) -> list[DataFrame]:
    """The documents in order of doc_id, as about equal batches."""
    cuts = sorted(set(docs.approxQuantile("doc_id", [i / batches for i in range(1, batches)], 0.01))) if batches > 1 else []
    edges = [None, *cuts, None]
    return [docs.where((F.lit(True) if a is None else F.col("doc_id") > a) & (F.lit(True) if b is None else F.col("doc_id") <= b))
            for a, b in zip(edges, edges[1:])]


def merged_cuts(found: DataFrame) -> DataFrame:
    """One row per document: starts and ends of its removed runs, in turn."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut = []
            for packed in batch.column("cut"):
                packed = packed.values.to_numpy()
                _, start, end = merged_intervals(np.zeros_like(packed), packed >> 32, packed & 0xFFFFFFFF)
                cut.append(np.stack([start, end], axis=1).ravel())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(cut, pa.list_(pa.int64()))], ["doc_id", "cut"])

    packed = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("end").cast("long"))
    return found.groupBy("doc_id").agg(F.collect_set(packed).alias("cut")).mapInArrow(run, "doc_id long, cut array<long>")


def remove_repeats(docs: DataFrame, length: int = 100, batches: int = 4, hot_rows: int = 20_000, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the remaining bytes of every document."""
    texts = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    known = texts.where("doc_id is not null")
    size = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // PART_BYTES))
    family, found = SuffixFamily(length, hot_rows, partitions), None
    parts = batches_of(known, batches)
    for i, part in enumerate(parts):
        intervals = family.add(part, more=i + 1 < len(parts))
        found = intervals if found is None else found.union(intervals)
    for _, path, _ in family.levels:
        drop_stage(docs.sparkSession, path)
    by_doc = stage(merged_cuts(found), "cuts")
    if (by_doc.agg(F.sum(F.size("cut"))).first()[0] or 0) <= 2 * BROADCAST_CUTS:
        by_doc = F.broadcast(by_doc)

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "kept": []}
            for text, cuts in zip(batch.column("text"), batch.column("cut").to_pylist()):
                data, kept, at, spans = text.as_buffer().to_pybytes(), [], 0, 0
                for a, b in zip((cuts or [])[::2], (cuts or [])[1::2]):
                    if a < len(data):           # rows repeated under one doc_id may have other texts
                        kept.append(data[at:a])
                        at, spans = min(b, len(data)), spans + 1
                body = b"".join(kept) + data[at:]
                for name, value in zip(out, (len(data), len(data) - len(body), spans, hashlib.sha256(body).hexdigest(), body)):
                    out[name].append(value)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, t) for v, t in zip(out.values(), kinds))], ["doc_id", *out])

    return (texts.join(by_doc, "doc_id", "left").select("doc_id", "text", "cut")
            .mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))
