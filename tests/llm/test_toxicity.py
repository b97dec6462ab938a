import zlib

import numpy as np
from pyspark.sql import functions as F

from payrun.llm import toxicity as T
from payrun.llm import wordbytes

SCHEMA = "doc_id long, text string, lang string, score string"


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    words = wordbytes.split_words(["alpha beta gamma delta " * 12, "one two", "übel 漢字 x"])
    x, first = T.text_inputs(words)
    start, length, _ = T.windows(first)
    y, weight = rng.integers(0, 2, len(start)).astype(np.float32), np.ones(len(start))
    net = T.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}

    def loss():
        z = net.forward(net.embed(x), start, length)
        return float((np.logaddexp(0, z) - y * z).mean())

    for name, g in net.gradients(x, start, length, y, weight).items():
        flat = net.p[name].reshape(-1)
        for i in np.argsort(-np.abs(g.reshape(-1)))[:4]:
            old = flat[i]
            flat[i] = old + 1e-3
            up = loss()
            flat[i] = old - 1e-3
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-3 - g.reshape(-1)[i]) < 2e-3, name


def test_windows_cover_every_word():
    for n in (0, 1, 8, 9, 32, 33, 56, 57, 500):
        start, length, text = T.windows(np.array([0, n, n]))
        covered = {w for s, k in zip(start, length) for w in range(s, s + k)}
        assert covered == set(range(n)) and (text == 0).all()
        assert all(b - a == T.STRIDE for a, b in zip(start, start[1:]))


def sample(n, start=0):
    rng = np.random.default_rng(start)
    plain = [f"{a}{b}" for a in ("tha", "ere", "ing", "ou", "nd") for b in ("the", "an", "in", "re", "st")]
    rows = []
    for i in range(start, start + n):
        words = list(rng.choice(plain, rng.integers(5, 120)))
        if i % 3 == 0:
            words[rng.integers(0, len(words))] = ["scumlord", "zzkrat", "vexxor"][rng.integers(0, 3)]
        rows.append((i, " ".join(words), "en", "x"))
    return rows


def test_learns_and_finds_one_word_in_a_long_text(spark):
    rows = sample(600)
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)] + [(7, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    model = T.fit(docs, labels)
    fresh = sample(200, 5000)
    got = {r.doc_id: r.score for r in T.score(spark.createDataFrame(fresh, SCHEMA), model, keep=("lang",)).collect()}
    right = [(got[i] >= T.THRESHOLD) == (i % 3 == 0) for i, *_ in fresh]
    assert np.mean(right) > 0.95
    long = " ".join(w for i, t, *_ in sample(400, 1) if i % 3 for w in t.split())
    clean, toxic = model.scores([long, long + " zzkrat "])
    assert toxic > clean and toxic >= T.THRESHOLD
    edges = spark.createDataFrame([(1, None, "", ""), (2, "", "", ""), (3, " 12 ", "", ""), (4, "a" * 300_000, "", ""), (None, "x", "", "")], SCHEMA)
    scores = [r.score for r in T.score(edges, model).collect()]
    assert scores[:3] == [0.0, 0.0, 0.0] and all(0 <= s <= 1 for s in scores)
    assert T.score(docs.limit(0), model).count() == 0


def test_without_both_classes(spark):
    docs = spark.createDataFrame([(1, "a b", "", "")] * 2, SCHEMA)
    assert T.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int")) is None
    assert [r.score for r in T.score(docs, None).collect()] == [0.0, 0.0]


def test_held_out_rule(spark):
    rows = spark.range(40).select("id", T.held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)


def test_one_id_on_many_rows_brings_a_bounded_number_of_texts(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(T, "train", lambda texts, y, prior: seen.update(texts=texts, y=y))
    docs = spark.createDataFrame([(1, f"bad {i}") for i in range(3000)] + [(2, "good")] * 3000 + [(3, "fine")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, toxic int")
    T.fit(docs, labels, per_class=50)
    assert 60 < sum(seen["y"] == 1) <= 100 and sorted(t for t, y in zip(seen["texts"], seen["y"]) if y == 0) == ["fine", "good"]


def test_training_embeds_the_words_of_some_windows_at_a_time(monkeypatch):
    words, embed = [], T.Network.embed
    monkeypatch.setattr(T.Network, "embed", lambda self, x: words.append(len(x.word)) or embed(self, x))
    texts = [" ".join(f"w{(i * 7 + j * 13) % 997}" for j in range(3000)) for i in range(50)]
    T.train(texts, np.arange(50) % 2 * 1.0, 0.5, rounds=1)
    assert max(words) <= 2048 * T.WINDOW < 40 * 3000
