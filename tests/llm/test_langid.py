import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from payrun.llm import langid, wordbytes

SCHEMA = "doc_id long, text string, lang string, score string"
EN = "the house and the garden with this weather thing that they have "
DE = "der garten und das haus mit dem wetter nicht auf die strasse "
RU = "дом и сад с этой погодой не на улицу "


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, " ".join([EN, DE, RU][i % 3].split()[i % 4:]), ["en", "de", "ru"][i % 3], "") for i in range(30)]
    return langid.fit(spark.createDataFrame(rows + [(99, None, "en", ""), (98, "x", None, "")], SCHEMA))


def best_path(model, scores):
    """Viterbi over all languages, word by word."""
    k = scores.shape[1]
    v, back = scores[0].copy(), []
    for s in scores[1:]:
        step = v[None, :] - model.penalty * (1 - np.eye(k))
        back.append(step.argmax(axis=1))
        v = step.max(axis=1) + s
    return v.max()


def path_score(model, scores, label):
    return scores[np.arange(len(label)), label].sum() - model.penalty * (label[1:] != label[:-1]).sum()


def test_viterbi_is_optimal_for_ragged_batches(model):
    texts = [EN * 3 + DE * 3, "", DE, RU + EN, None, "the", EN * 40 + RU * 2 + DE * 9, "дом the der 12 --"]
    words = wordbytes.split_words(texts)
    scores, label = model.word_scores(words).astype(np.float64), model.label(words)
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b > a:
            assert np.isclose(path_score(model, scores[a:b], label[a:b]), best_path(model, scores[a:b]), rtol=1e-5)


def test_spans_scripts_and_edges(spark, model):
    texts = [EN * 4 + DE * 6, RU, None, "", "12 — ...!", "— “”", EN.upper(), "x" * 200_000, EN * 3 + RU]
    docs = spark.createDataFrame([(i, t, "zz", "clash") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert got[0].lang_pred == "de" and [s.lang for s in got[0].spans] == ["en", "de"]
    assert got[0].spans[0].end == got[0].spans[1].start == 4 * len(EN.split())
    assert got[1].lang_pred == "ru" and got[1].score == 1.0
    assert all(got[i].lang_pred == "und" and got[i].score == 0.0 for i in (2, 3, 4, 5))
    assert got[6].lang_pred == "en" and got[7].lang_pred in ("de", "en")
    assert [s.lang for s in got[8].spans] == ["en", "ru"]


def test_empty_tables_and_repeats(spark, model):
    none = spark.createDataFrame([], SCHEMA)
    assert langid.identify(none, model).count() == 0
    blank = langid.fit(none)
    docs = spark.createDataFrame([(1, EN, None, ""), (1, EN, None, "")], SCHEMA)
    assert [r.lang_pred for r in langid.identify(docs, blank).collect()] == ["und", "und"]
    assert len({tuple(r) [:3] for r in langid.identify(docs, model).collect()}) == 1


def test_held_out_rule(spark):
    rows = spark.range(40).select("id", langid.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = langid.held_out(F.col("doc_id"))
    found = langid.identify(docs.where(held), langid.fit(docs.where(~held))).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0] > 0.98
