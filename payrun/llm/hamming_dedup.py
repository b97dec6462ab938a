"""Near-duplicate documents by a multi-index Hamming join of minhash signatures.

A document's set of word shingles gets a signature of ``chunks * width`` minhash
components of 8 bits. Pairs within Hamming distance ``radius = chunks * (errors + 1) - 1``
agree, by the pigeonhole principle, in some chunk up to ``errors`` components, so
indexing each chunk under every choice of components left out finds all of them.
At the defaults a pair of similarity 0.8 differs in 12 of 60 components on average,
and exceeds the radius of 23 with a chance of about 2 in 10,000.

Sets that are equal share one node. Links are confirmed on full sets:

1. each node is compared with the nearest of its buckets' first nodes;
2. what these links leave in different components, though some bucket holds both
   and the signatures are near, forms families; within them every such pair is
   compared. Large buckets and families are cut in blocks, and pairs of blocks
   are compared by tasks of their own; blocks inside one component are skipped.

So no link between different texts is lost, copies are never expanded into pairs,
and pairs stay inside tasks: only confirmed links come out.

Defined results: null text, and text without words, has an empty set and no link;
a null doc_id is in no class but its own, with a null component; rows repeated
under one doc_id are judged by their own text; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from payrun.llm.common import stage
from payrun.llm.components import components
from payrun.llm.shingles import Signer, WordHashes, mix, shingle_set, similar, words_of

CHUNKS, WIDTH, ERRORS = 12, 5, 1
RADIUS = CHUNKS * (ERRORS + 1) - 1
#: Ids that a task may hold as a broadcast table (8 MB); larger sets of ids are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Texts, or shingle sets, that go to Python at a time.
BATCH_ROWS = 1000


def sign(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, set size, a 128-bit key of the set, and the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, signer = WordHashes(), Signer(CHUNKS * WIDTH)
        for batch in batches:
            sizes, keys, sigs = [], [], []
            for text in batch.column(1):
                s = shingle_set(words_of(text.as_py()), n, hashes)
                sizes.append(len(s))
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sigs.append(signer(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array(sigs, pa.binary())], ["doc_id", "n", "set_key", "sig"])

    return (docs.select(docs[id_col].cast("long"), docs[text_col])
            .mapInArrow(run, "doc_id long, n long, set_key binary, sig binary"))


def bucket_keys(sigs: np.ndarray) -> np.ndarray:
    """One key for each chunk and component left out of it."""
    out = []
    for chunk in range(CHUNKS):
        part = sigs[:, chunk * WIDTH:(chunk + 1) * WIDTH].astype(np.uint64)
        for left_out in range(WIDTH):
            key = np.full(len(sigs), np.uint64(chunk * WIDTH + left_out + 1))
            for i in range(WIDTH):
                if i != left_out:
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part[:, i])
            out.append(key)
    return np.stack(out, axis=1)


def matrix(sigs) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.uint8).reshape(-1, CHUNKS * WIDTH)


def keyed(nodes: DataFrame) -> DataFrame:
    """(key, node) of every node and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys = bucket_keys(matrix(batch.column(1).to_pylist()))
                node = np.repeat(batch.column(0).to_numpy(), keys.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(node)], ["key", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "key long, node long")


def sets_of(docs: DataFrame, ids: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles) of the documents named in ``ids(node)``, in full."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(words_of(t.as_py()), n, hashes).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])

    ids = stage(ids.distinct(), "ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    texts = docs.select(docs[id_col].cast("long").alias("node"), docs[text_col].alias("text")).join(ids, "node")
    return stage(texts.mapInArrow(run, "node long, shingles binary"), "sets", BATCH_ROWS)


def near_pairs(sigs: np.ndarray, sizes: np.ndarray, num: int, den: int, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each of ``rows``, the later rows within the radius whose sizes allow a link."""
    for i in rows:
        distance = (sigs[i + 1:] != sigs[i]).sum(axis=1)
        low, high = np.minimum(sizes[i + 1:], sizes[i]), np.maximum(sizes[i + 1:], sizes[i])
        yield i, i + 1 + np.flatnonzero((distance <= RADIUS) & (den * low >= num * high))


class Forest:
    """Union-find of labels."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def runs_of_equal(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Sorted rows, one frame for each value of ``keys``, across batches."""
    held = None
    for batch in batches:
        pdf = batch.to_pandas()
        pdf = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        code = pdf[keys].to_numpy()
        cuts = np.flatnonzero((code[1:] != code[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts[:-1]], cuts):
            yield pdf.iloc[a:b]
        held = pdf.iloc[cuts[-1] if len(cuts) else 0:]
    if held is not None and len(held):
        yield held


def first_links(docs, members, nodes, n, num, den, id_col, text_col) -> DataFrame:
    """Confirmed links (a, b) of each node with the nearest of its buckets' first nodes."""
    left = nodes.select(F.col("node").alias("b"), F.col("sig").alias("sig_b"), F.col("n").alias("n_b"))
    right = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sig_a"), F.col("n").alias("n_a"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sig_a, sig_b = (matrix(batch.column(c).to_pylist()) for c in ("sig_a", "sig_b"))
                distance = pa.array((sig_a != sig_b).sum(axis=1).astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), distance], ["a", "b", "distance"])

    pairs = members.where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    near = (pairs.join(left, "b").join(right, "a").where(den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b"))
            .mapInArrow(measure, "a long, b long, distance int").where(F.col("distance") <= RADIUS))
    best = stage(near.groupBy("b").agg(F.min(F.struct("distance", "a")).alias("best"))
                 .select(F.col("best.a").alias("a"), "b"), "first_pairs")
    sets = sets_of(docs, best.select(F.col("a").alias("node")).union(best.select("b")), n, id_col, text_col)

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), num, den)
                    for x, y in zip(batch.column("set_a"), batch.column("set_b"))]
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    full = (best.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b")), "b")
            .join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a")), "a").select("a", "b", "set_a", "set_b"))
    return stage(full.mapInArrow(confirm, "a long, b long"), "first_links", BATCH_ROWS)


def blocked(rows: DataFrame, counts: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Rows in cells of at most about twice ``size`` rows; a larger group becomes all
    pairs of its blocks."""
    n = F.greatest(F.lit(1), F.ceil(F.col("rows") / size)).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    cell = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                       lambda j: F.struct(F.least("own", j).alias("i"), F.greatest("own", j).alias("j")))
    return (rows.join(counts, keys).withColumn("blocks", n).withColumn("own", own).withColumn("cell", F.explode(cell))
            .select(*rows.columns, F.col("cell.i").alias("i"), F.col("cell.j").alias("j")))


def families(members: DataFrame, nodes: DataFrame, comps: DataFrame, num: int, den: int, block: int) -> DataFrame:
    """(node, comp, family): nodes of different components that share a bucket and have
    near signatures are in one family."""
    label = F.coalesce("comp", "node").alias("comp")
    named = members.select("key", "node").join(comps, "node", "left").select("key", "node", label)
    mixed = (named.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("rows"))
             .where("low < high").select("key", "rows"))
    rows = blocked(named, mixed, ["key"], block).join(nodes, "node")

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for pdf in runs_of_equal(batches, ["key", "i", "j"]):
            sigs, node, comp, size = matrix(pdf["sig"]), pdf["node"].to_numpy(), pdf["comp"].to_numpy(), pdf["n"].to_numpy()
            seen = Forest()
            for i, js in near_pairs(sigs, size, num, den, np.arange(len(node) - 1)):
                out += [(int(node[i]), int(node[j])) for j in js[comp[js] != comp[i]] if seen.join(int(node[i]), int(node[j]))]
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])

    edges = (rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")
             .select("key", "i", "j", "node", "comp", "n", "sig").mapInArrow(forest, "a long, b long").distinct())
    found = components(edges).withColumnRenamed("comp", "family")
    return stage(found.join(comps, "node", "left").select("node", label, "family"), "families")


def family_links(docs, found, nodes, n, num, den, block, id_col, text_col) -> DataFrame:
    """Confirmed links between different components of each family."""
    sizes = found.groupBy("family", "comp").agg(F.count("*").alias("comp_rows"))
    small = (sizes.groupBy("family").agg(F.sum(F.when(F.col("comp_rows") < block, F.col("comp_rows"))).alias("small_rows")))
    large = F.col("comp_rows") >= block
    count = F.greatest(F.lit(1), F.ceil(F.when(large, F.col("comp_rows")).otherwise(F.col("small_rows")) / block))
    name = F.concat(F.when(large, F.concat(F.col("comp").cast("string"), F.lit("-"))).otherwise("small-"),
                    F.pmod(F.xxhash64("node"), count).cast("string"))
    placed = stage(found.join(sizes, ["family", "comp"]).join(small, "family")
                   .select("family", "node", "comp", name.alias("block"), F.when(large, F.col("comp")).alias("pure")), "placed")
    blocks = placed.select("family", "block", "pure").distinct()
    other = blocks.select("family", F.col("block").alias("block2"), F.col("pure").alias("pure2"))
    cells = (blocks.join(other, "family").where((F.col("block") <= F.col("block2"))
                                                & ~F.coalesce(F.col("pure") == F.col("pure2"), F.lit(False)))
             .select("family", "block", "block2"))
    sides = (cells.select("family", "block", F.col("block").alias("i"), F.col("block2").alias("j"))
             .union(cells.select("family", "block2", "block", "block2")).distinct())
    sets = sets_of(docs, placed.select("node"), n, id_col, text_col)
    rows = (placed.join(sides, ["family", "block"]).join(nodes, "node").join(sets, "node")
            .select("family", "i", "j", "node", "comp", "n", "sig", "shingles"))

    def confirm(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        sets = [np.frombuffer(s, np.uint64) for s in pdf["shingles"]]
        node, comp, joined, out = pdf["node"].to_numpy(), pdf["comp"].to_numpy(), Forest(), []
        for i, js in near_pairs(matrix(pdf["sig"]), pdf["n"].to_numpy(), num, den, np.arange(len(node) - 1)):
            for j in js:
                a, b = int(comp[i]), int(comp[j])
                if joined.root(a) != joined.root(b) and similar(sets[i], sets[j], num, den):
                    joined.join(a, b)
                    out.append((node[i], node[j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return stage(rows.groupBy("family", "i", "j").applyInPandas(confirm, "a long, b long"), "family_links")


def near_duplicates(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                    text_col: str = "text", bucket_block: int = 2000, family_block: int = 400) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``: links join
    documents with ``den * |a and b| >= num * |a or b|`` on their ``n``-word shingles."""
    signed = stage(sign(docs, n, id_col, text_col), "signed", BATCH_ROWS)
    whole = signed.where("set_key is not null and doc_id is not null")
    by_set = stage(whole.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.first("n").alias("n"), F.first("sig").alias("sig")), "nodes")
    nodes = by_set.select("node", "n", "sig")
    keys = keyed(nodes)
    shared = keys.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("rows")).where("rows > 1")
    members = stage(keys.join(shared.select("key", "first"), "key"), "members")
    links = first_links(docs, members, nodes, n, num, den, id_col, text_col)
    found = families(members, nodes, components(links), num, den, bucket_block)
    links = links.union(family_links(docs, found, nodes, n, num, den, family_block, id_col, text_col))
    comps = components(links)
    named = by_set.join(comps, "node", "left").select("set_key", F.coalesce("comp", "node").alias("component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (signed.join(named, "set_key", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))
