"""Toxicity scores from a bidirectional gated recurrent network, trained in numpy.

A word enters the network as the embedding of its hash joined with the mean
embedding of its byte trigrams. Forward and backward GRUs run over windows of
``WINDOW`` words that overlap by ``OVERLAP`` words; attention pools the states of a
window into one logit. A document's logit is the highest of all its windows, and
Platt scaling on documents kept out of the training turns it into a score. A word
that follows itself counts once.

Only documents are labelled, so training is multiple-instance learning: each
round scores all windows of the sample; a toxic document then trains its best
window (and those already above one half), a clean one its worst and some others.
The sample is bounded by ``per_class`` labelled documents of each class; scoring
reads every word of every text.

Defined results: null text, and text without words, scores 0; labels other than
0 and 1, and null ones, are not learned from; a document labelled twice counts
by its highest label; without both classes all scores are 0; repeated rows score
alike; extra input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrun.llm.common import bounded
from payrun.llm import wordbytes as WB
from payrun.llm.boosting import platt, sigmoid

WINDOW, OVERLAP = 32, 8
STRIDE = WINDOW - OVERLAP
WORD_BITS, GRAM_BITS = 18, 15
WORD_DIM, GRAM_DIM, HIDDEN = 8, 8, 8
THRESHOLD = 0.3


@dataclass
class Inputs:
    """Hashed inputs of a run of words."""

    word: np.ndarray        # one hash a word
    gram: np.ndarray        # hashed trigrams of all words in a row
    begin: np.ndarray       # where each word's trigrams begin
    length: np.ndarray

    def part(self, lo: int, hi: int) -> "Inputs":
        a, b = int(self.begin[lo]), int(self.begin[hi - 1] + self.length[hi - 1])
        return Inputs(self.word[lo:hi], self.gram[a:b], self.begin[lo:hi] - a, self.length[lo:hi])


def word_inputs(words: WB.Words, lo: int, hi: int) -> Inputs:
    gram, begin = WB.trigrams(words, lo, hi, GRAM_BITS)
    length = words.ends[lo:hi] - words.starts[lo:hi]
    mixed = WB.hashes(words, lo, hi)
    return Inputs((mixed >> np.uint64(64 - WORD_BITS)).astype(np.int64), gram, begin, length)


def text_inputs(words: WB.Words) -> tuple[Inputs, np.ndarray]:
    """Inputs of whole texts, and where the words of each text begin; a word that
    follows itself counts once, so that mere repetition adds no evidence."""
    if not len(words.starts):
        none = np.zeros(0, np.int64)
        return Inputs(none, none, none, none), np.zeros(len(words.first), np.int64)
    parts = [word_inputs(words, lo, hi) for lo, hi in WB.blocks(words)]
    word, length = np.concatenate([p.word for p in parts]), np.concatenate([p.length for p in parts])
    keep = np.ones(len(word), bool)
    keep[1:] = (word[1:] != word[:-1]) | (length[1:] != length[:-1])
    keep[words.first[:-1][np.diff(words.first) > 0]] = True
    gram = np.concatenate([p.gram.astype(np.uint16) for p in parts])[np.repeat(keep, length)]
    length = length[keep]
    return (Inputs(word[keep], gram, np.cumsum(length) - length, length),
            np.concatenate([[0], np.cumsum(keep)])[words.first])


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and length of all windows of texts whose words begin at ``first``, and
    the text of each; a text without words has none."""
    count = np.diff(first)
    per_text = np.where(count > 0, np.maximum(1, -(-(count - OVERLAP) // STRIDE)), 0)
    text = np.repeat(np.arange(len(count)), per_text)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    start = first[text] + rank * STRIDE
    return start, np.minimum(WINDOW, first[text + 1] - start), text


class Network:
    """Parameters by name, forward pass, and gradients by back-propagation through time."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)

        def draw(scale, *shape):
            return rng.normal(0, scale, shape).astype(np.float32)

        d = WORD_DIM + GRAM_DIM
        self.p = {"word": draw(0.02, 1 << WORD_BITS, WORD_DIM), "gram": draw(0.5, 1 << GRAM_BITS, GRAM_DIM),
                  "wf": draw(d ** -0.5, d, 3 * HIDDEN), "wb": draw(d ** -0.5, d, 3 * HIDDEN),
                  "bf": draw(0, 3 * HIDDEN), "bb": draw(0, 3 * HIDDEN),
                  "uf": draw(HIDDEN ** -0.5, HIDDEN, 3 * HIDDEN), "ub": draw(HIDDEN ** -0.5, HIDDEN, 3 * HIDDEN),
                  "attend": draw(0.3, 2 * HIDDEN), "out": draw(0.3, 2 * HIDDEN), "bias": draw(0, 1)}

    def embed(self, x: Inputs) -> np.ndarray:
        grams = np.add.reduceat(self.p["gram"][x.gram], x.begin, axis=0) / x.length[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][x.word], grams], axis=1)

    def _direction(self, gates: np.ndarray, at: np.ndarray, mask: np.ndarray, u: np.ndarray, order, keep: list | None):
        states = np.zeros((at.shape[0], at.shape[1], HIDDEN), np.float32)
        h = np.zeros((at.shape[1], HIDDEN), np.float32)
        k = HIDDEN
        for t in order:
            g = gates[at[t]]
            hu = h @ u
            zr = g[:, :2 * k] + hu[:, :2 * k]
            zr = 1 / (1 + np.exp(-zr))
            new = np.tanh(g[:, 2 * k:] + zr[:, k:] * hu[:, 2 * k:])
            if keep is not None:
                keep.append((t, h, zr, new, hu[:, 2 * k:]))
            h = (new + zr[:, :k] * (h - new)) * mask[t][:, None]
            states[t] = h
        return states

    def forward(self, embedded: np.ndarray, start: np.ndarray, length: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logits of windows over the embedded words."""
        p, steps = self.p, np.arange(WINDOW)[:, None]
        at = np.minimum(start[None] + steps, len(embedded) - 1)
        mask = (steps < length[None]).astype(np.float32)
        kf, kb = ([], []) if keep is not None else (None, None)
        hf = self._direction(embedded @ p["wf"] + p["bf"], at, mask, p["uf"], range(WINDOW), kf)
        hb = self._direction(embedded @ p["wb"] + p["bb"], at, mask, p["ub"], range(WINDOW - 1, -1, -1), kb)
        h = np.concatenate([hf, hb], axis=2)
        a = np.where(mask > 0, h @ p["attend"], -1e9)
        a = np.exp(a - a.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", a, h)
        if keep is not None:
            keep.update(at=at, mask=mask, kf=kf, kb=kb, h=h, a=a, pooled=pooled)
        return pooled @ p["out"] + p["bias"][0]

    def in_turns(self, x: Inputs, start: np.ndarray, length: np.ndarray, most: int = 2048) -> Iterator[tuple[int, np.ndarray]]:
        """Logits of ``most`` windows at a time, and the place of the first: only the words
        of these windows are embedded at once, whatever the length of all texts."""
        for a in range(0, len(start), most):
            s, n = start[a:a + most], length[a:a + most]
            lo, hi = int(s[0]), int((s + n).max())
            yield a, self.forward(self.embed(x.part(lo, hi)), s - lo, n)

    def gradients(self, x: Inputs, start: np.ndarray, length: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        """Of the mean weighted log loss of these windows."""
        p, keep = self.p, {}
        embedded = self.embed(x)
        d_logit = ((sigmoid(self.forward(embedded, start, length, keep)) - y) * weight / weight.sum()).astype(np.float32)
        h, a = keep["h"], keep["a"]
        g = {"bias": d_logit.sum(keepdims=True), "out": keep["pooled"].T @ d_logit}
        d_pooled = d_logit[:, None] * p["out"]
        d_a = np.einsum("bh,tbh->tb", d_pooled, h)
        d_score = a * (d_a - (a * d_a).sum(axis=0))
        g["attend"] = np.einsum("tb,tbh->h", d_score, h)
        d_h = a[:, :, None] * d_pooled[None] + d_score[:, :, None] * p["attend"]
        d_embedded = np.zeros_like(embedded)
        for side, u, w, part in (("kf", "uf", "wf", d_h[:, :, :HIDDEN]), ("kb", "ub", "wb", d_h[:, :, HIDDEN:])):
            d_gates = self._back(keep[side], part, keep["mask"], p[u], g, u)
            flat = np.zeros((len(embedded), 3 * HIDDEN), np.float32)
            np.add.at(flat, keep["at"].ravel(), d_gates.reshape(-1, 3 * HIDDEN))
            g[w] = embedded.T @ flat
            g["b" + w[1]] = flat.sum(axis=0)
            d_embedded += flat @ p[w].T
        g["word"] = np.zeros_like(p["word"])
        np.add.at(g["word"], x.word, d_embedded[:, :WORD_DIM])
        g["gram"] = np.zeros_like(p["gram"])
        spread = d_embedded[:, WORD_DIM:] / x.length[:, None].astype(np.float32)
        np.add.at(g["gram"], x.gram, np.repeat(spread, x.length, axis=0))
        return g

    def _back(self, steps: list, d_states: np.ndarray, mask: np.ndarray, u: np.ndarray, g: dict, name: str) -> np.ndarray:
        k = HIDDEN
        d_gates = np.zeros((*d_states.shape[:2], 3 * k), np.float32)
        g[name] = np.zeros_like(u)
        carry = np.zeros(d_states.shape[1:], np.float32)
        for t, before, zr, new, hn in reversed(steps):
            d = (d_states[t] + carry) * mask[t][:, None]
            z, r = zr[:, :k], zr[:, k:]
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (before - new) * z * (1 - z)
            d_r = d_new * hn * r * (1 - r)
            d_gates[t] = np.concatenate([d_z, d_r, d_new], axis=1)
            d_hu = np.concatenate([d_z, d_r, d_new * r], axis=1)
            g[name] += before.T @ d_hu
            carry = d * z + d_hu @ u.T
        return d_gates


@dataclass
class ToxicityModel:
    network: Network
    slope: float
    offset: float

    def logits(self, texts: list[str | None], group_bytes: int = 1 << 20) -> np.ndarray:
        """The highest window logit of each text; -inf where there is no word."""
        best = np.full(len(texts), -np.inf, np.float32)
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size < group_bytes):
                size += len(texts[stop] or "")
                stop += 1
            inputs, first = text_inputs(WB.split_words(texts[at:stop]))
            start, length, text = windows(first)
            for a, logit in self.network.in_turns(inputs, start, length):
                np.maximum.at(best, at + text[a:a + len(logit)], logit)
            at = stop
        return best

    def scores(self, texts: list[str | None]) -> np.ndarray:
        logit = self.logits(texts)
        known = np.isfinite(logit)
        return np.where(known, sigmoid(self.slope * np.where(known, logit, 0) + self.offset), 0.0)


def train(texts: list[str], y: np.ndarray, prior: float, rounds: int = 9, seed: int = 7) -> ToxicityModel:
    """Multiple-instance training; every fifth text is kept out for calibration."""
    rng = np.random.default_rng(seed)
    model = ToxicityModel(Network(seed), 1.0, 0.0)
    kept_out = np.arange(len(texts)) % 5 == 4
    learn = np.flatnonzero(~kept_out)
    toxic = y[learn] > 0
    inputs, first = text_inputs(WB.split_words([texts[i] for i in learn]))
    start, length, text = windows(first)
    moment: dict[str, list] = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in model.network.p.items()}
    step = 0

    def part(at: np.ndarray) -> tuple[Inputs, np.ndarray]:
        """Inputs of the words of these windows alone, and where each window starts."""
        span = np.concatenate([np.arange(start[i], start[i] + length[i]) for i in at])
        size = inputs.length[span]
        grams = np.repeat(inputs.begin[span] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return (Inputs(inputs.word[span], inputs.gram[grams], np.cumsum(size) - size, size),
                np.cumsum(length[at]) - length[at])

    for turn in range(rounds if len(start) else 0):
        logit = np.concatenate([part for _, part in model.network.in_turns(inputs, start, length)])
        order = np.lexsort((-logit, text))
        top = order[np.unique(text[order], return_index=True)[1]]
        of_toxic = toxic[text]
        good = np.union1d(top[of_toxic[top]], np.flatnonzero(of_toxic & (logit > 0)))
        clean = np.flatnonzero(~of_toxic)
        bad = np.union1d(top[~of_toxic[top]], rng.choice(clean, min(len(clean), len(top)), replace=False))
        chosen = rng.permutation(np.concatenate([good, bad]))
        batch = int(np.clip(len(chosen) // 16, 16, 384))
        weight = np.where(of_toxic, 0.5 / max(1, len(good)), 0.5 / max(1, len(bad)))
        for a in range(0, len(chosen), batch):
            at = np.sort(chosen[a:a + batch])
            x, begin = part(at)
            grads = model.network.gradients(x, begin, length[at], of_toxic[at].astype(np.float32), weight[at])
            step += 1
            for name, g in grads.items():
                m, v = moment[name]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                model.network.p[name] -= (0.02 * 0.85 ** turn * (m / (1 - 0.9 ** step))
                                          / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    logit = model.logits([texts[i] for i in np.flatnonzero(kept_out)])
    known = np.isfinite(logit)
    truth = y[kept_out][known]
    if len(set(truth)) == 2:
        model.slope, model.offset = platt(np.clip(logit[known], -20, 20), truth)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    prior = np.clip(prior, 1e-3, 1 - 1e-3)
    model.offset += float(np.log(prior / (1 - prior)) - np.log(share / (1 - share)))
    return model


def held_out(id_col: Column) -> Column:
    """Documents whose labels are never learned: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        per_class: int = 1200) -> ToxicityModel | None:
    """Train on about ``per_class`` labelled documents of each class, chosen by the
    hash of their id; None without both classes. Each text of an id counts once, and
    never more than twice ``per_class`` texts of a class come to the driver."""
    known = (labels.where(labels[label_col].isin(0, 1) & labels[id_col].isNotNull())
             .groupBy(labels[id_col].alias("id")).agg(F.max(label_col).alias("y")))
    seen = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(seen) < 2:
        return None
    share = F.when(F.col("y") == 1, int(min(1.0, per_class / seen[1]) * (1 << 30)))
    share = share.otherwise(int(min(1.0, per_class / seen[0]) * (1 << 30)))
    chosen = known.where(F.pmod(F.xxhash64("id", F.lit("toxic")), F.lit(1 << 30)) < share)
    rows = (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where("text is not null")
            .join(F.broadcast(chosen), "id").select("id", "y", "text"))         # about 2 * per_class rows, more where ids repeat
    order = F.xxhash64("id", "text")
    texts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.approx_count_distinct(order).alias("n")).collect()}
    kept = F.lit(1 << 30)
    for y, n in texts.items():
        kept = F.when(F.col("y") == y, int(min(1.0, 2 * per_class / max(n, 1)) * (1 << 30))).otherwise(kept)
    rows = rows.where(F.pmod(order, F.lit(1 << 30)) < kept).dropDuplicates(["id", "text"])
    rows = bounded(rows, order, 2 * per_class, by="y").toPandas().sort_values(["id", "text"], kind="stable")
    if rows.y.nunique() < 2:
        return None
    return train(rows.text.tolist(), rows.y.to_numpy(float), seen[1] / (seen[0] + seen[1]))


def score(docs: DataFrame, model: ToxicityModel | None, id_col: str = "doc_id", text_col: str = "text",
          keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id and score of every document, with the columns of ``keep``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # fixed size, about 10 MB
    columns = docs.select(docs[id_col], *[docs[c] for c in keep], docs[text_col].alias("scored_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema[:-1]) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = shared.value.scores(texts) if shared.value else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.float64())],
                                             [*batch.schema.names[:-1], "score"])

    return columns.mapInArrow(run, schema)
