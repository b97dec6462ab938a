"""Language spans of mixed-language text by Viterbi over per-word scores.

The script of a word narrows its candidate languages to those that were seen in
that script; byte trigrams score the word under each candidate; Viterbi with a
penalty for switching labels the words, and runs of one label are the spans. A
document's language is the one with most letters in its spans, its score their
share.

The model is fitted on a bounded sample: about ``per_language`` labelled documents
of each language. Scoring reads whole texts, many at a time: all documents of a
batch take a Viterbi step together.

Defined results: ``und`` with score 0 for null text, text without a letter, and
everything if nothing was learned; ties go to the language first by name;
repeated rows are labelled alike; extra input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from payrun.llm import wordbytes as WB

BITS = 16
UNKNOWN = "und"


@dataclass
class LangModel:
    languages: list[str]
    table: np.ndarray           # trigram x language: log probability
    allowed: np.ndarray         # script x language
    penalty: float

    def word_scores(self, words: WB.Words) -> np.ndarray:
        out = np.empty((len(words.starts), len(self.languages)), np.float32)
        for lo, hi in WB.blocks(words):
            grams, begin = WB.trigrams(words, lo, hi, BITS)
            score = np.add.reduceat(self.table[grams], begin, axis=0)
            ok = self.allowed[WB.scripts(words, lo, hi)]
            out[lo:hi] = np.where(ok | ~ok.any(axis=1, keepdims=True), score, score - 1000)
        return out

    def label(self, words: WB.Words) -> np.ndarray:
        """Best language of every word; all texts advance by one word at a time."""
        scores = self.word_scores(words)
        first, count = words.first[:-1], np.diff(words.first)
        order = np.argsort(-count, kind="stable")
        first, count = first[order], count[order]
        longest = int(count[0]) if len(count) else 0
        active = np.searchsorted(-count, -np.arange(longest), side="left")
        n, k = scores.shape
        back, stays = np.zeros(n, np.int16), np.ones((n, k), bool)
        v = np.zeros((len(count), k), np.float32)
        for t in range(longest):
            m = active[t]
            at = first[:m] + t
            live = v[:m]
            if t:
                top = live.argmax(axis=1)
                jump = live[np.arange(m), top] - self.penalty
                back[at] = top
                stays[at] = live >= jump[:, None]
                live = np.maximum(live, jump[:, None])
            v[:m] = live + scores[at]
        label = np.zeros(n, np.int16)
        now = v.argmax(axis=1)
        for t in range(longest - 1, -1, -1):
            m = active[t]
            at = first[:m] + t
            here = now[:m]
            label[at] = here
            now[:m] = np.where(stays[at, here], here, back[at])
        return label

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, list[tuple[int, int, str]]]]:
        """Language, score and spans (first word, end word, language) of each text."""
        words = WB.split_words(texts)
        label = self.label(words) if self.languages else np.zeros(len(words.starts), np.int16)
        length = (words.ends - words.starts).astype(np.float64)
        out = []
        for i, text in enumerate(texts):
            a, b = int(words.first[i]), int(words.first[i + 1])
            if a == b or not self.languages or not has_letter(text):
                out.append((UNKNOWN, 0.0, []))
                continue
            own = label[a:b]
            letters = np.bincount(own, length[a:b], len(self.languages))
            best = int(letters.argmax())
            cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), b - a]
            spans = [(x, y, self.languages[own[x]]) for x, y in zip(cuts, cuts[1:])]
            out.append((self.languages[best], float(letters[best] / letters.sum()), spans))
        return out


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def held_out(id_col: Column) -> Column:
    """Documents that nothing is learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = 2000, penalty: float = 12.0, smooth: float = 0.5, rare_script: float = 1e-3) -> LangModel:
    """Trigram and script counts of about ``per_language`` documents of each language."""
    rows = labelled.select(labelled[id_col].alias("id"), labelled[text_col].alias("text"),
                           labelled[lang_col].alias("lang")).where("lang is not null and text is not null")
    seen = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    share = F.lit(0)
    for lang, count in seen.items():
        share = F.when(F.col("lang") == lang, int(min(1.0, per_language / count) * (1 << 30))).otherwise(share)
    sample = rows.where(F.pmod(F.xxhash64("id", F.lit("lang")), F.lit(1 << 30)) < share).select("text", "lang")

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        script: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            texts = batch.column(0).to_pylist()
            for lang in sorted(set(langs)):
                words = WB.split_words([t for t, x in zip(texts, langs) if x == lang])
                grams.setdefault(lang, np.zeros(1 << BITS, np.int64))
                script.setdefault(lang, np.zeros(WB.N_SCRIPTS, np.int64))
                for lo, hi in WB.blocks(words):
                    grams[lang] += np.bincount(WB.trigrams(words, lo, hi, BITS)[0], minlength=1 << BITS)
                    script[lang] += np.bincount(WB.scripts(words, lo, hi), minlength=WB.N_SCRIPTS)
        for lang in grams:
            yield pa.RecordBatch.from_pydict({"lang": [lang], "grams": [grams[lang].tobytes()],
                                              "script": [script[lang].tobytes()]})

    parts = sample.repartition(4).mapInArrow(count_grams, "lang string, grams binary, script binary").collect()
    languages = sorted({p["lang"] for p in parts})
    grams = np.zeros((1 << BITS, len(languages)))
    script = np.zeros((WB.N_SCRIPTS, len(languages)))
    for p in parts:
        i = languages.index(p["lang"])
        grams[:, i] += np.frombuffer(p["grams"], np.int64)
        script[:, i] += np.frombuffer(p["script"], np.int64)
    table = np.log((grams + smooth) / (grams.sum(axis=0) + smooth * (1 << BITS))).astype(np.float32)
    return LangModel(languages, table, script >= rare_script * np.maximum(1, script.sum(axis=0)), penalty)


def identify(docs: DataFrame, model: LangModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score and the language spans of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)      # fixed size: 2^16 trigrams a language
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = shared.value.predict(batch.column(1).to_pylist())
            spans = [[{"start": a, "end": b, "lang": x} for a, b, x in f[2]] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.float64()),
                 pa.array(spans, span)], ["doc_id", "lang_pred", "score", "spans"])

    return (docs.select(docs[id_col].cast("long"), docs[text_col])
            .mapInArrow(run, "doc_id long, lang_pred string, score double, "
                             "spans array<struct<start:int,end:int,lang:string>>"))
