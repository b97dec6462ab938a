import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from payrun.llm import decontam as D

DOCS, ITEMS = "doc_id long, text string, item_id string", "item_id long, text string, doc_id string"


def words(t):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower())


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def brute(docs, items, similarity=0.8):
    out = {}
    for i, text, _ in docs:
        w = words(text)
        for j, item, _ in items:
            x = words(item)
            if not x or not w:
                continue
            k, n = int((1 - similarity) * len(x) + 1e-9), min(len(x), len(w))
            if n < len(x) - k:
                continue
            best = min((levenshtein(w[s:s + n], x), s) for s in range(len(w) - n + 1))
            if best[0] <= k:
                out[i, j] = best
    return out


def test_edit_distance():
    rng = np.random.default_rng(0)
    for n, m in ((8, 8), (10, 8), (8, 10), (1, 1)):
        a, b = rng.integers(0, 3, (200, n)), rng.integers(0, 3, (200, m))
        want = np.array([levenshtein(x.tolist(), y.tolist()) for x, y in zip(a, b)])
        for most in (3, 12):
            got = D.edit_distance(a, b, most)
            assert ((got == want) | ((want > most) & (got > most))).all()


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"{a}{b}" for a in "bcdfgh" for b in ("a", "en", "ou9", "é")] + ["the", "of", "and"] * 6
    items = [(j, " ".join(rng.choices(vocab, k=rng.randint(5, 40))), "x") for j in range(25)]
    docs = []
    for i in range(160):
        w = rng.choices([f"z{k}" for k in range(300)] + vocab, k=rng.randint(0, 150))
        if i % 2:
            x = rng.choice(items)[1].split()
            for _ in range(rng.randint(0, max(0, len(x) // 6))):
                at = rng.randrange(len(x))
                x[at:at + rng.choice([0, 1, 1])] = [rng.choice(vocab)] if rng.random() < 0.7 else []
            s = rng.randint(0, len(w))
            w[s:s] = x
        docs.append((i, ", ".join(w).title(), "x"))
    return docs, items


@pytest.mark.parametrize("block", [20_000, 7])
def test_recall_and_precision_against_brute_force(spark, block):
    docs, items = corpus()
    want = brute(docs, items)
    got = {(r.doc_id, r.item_id): (r.distance, r.start_word) for r in D.contaminated(
        spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), item_block=block).collect()}
    assert set(got) <= set(want)
    assert len(got) >= 0.95 * len(want)
    assert all(got[p] == want[p] for p in want if want[p][0] == 0)
    assert all(got[p][0] >= want[p][0] for p in got)


def test_edges(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = [(1, None, ""), (2, "", ""), (3, passage.upper() + "!", ""), (4, "one two three four five six seven eight nine", ""),
            (5, "x " * 50_000 + passage + " y" * 50_000, ""), (5, passage, ""), (None, passage, ""), (6, "the " * 40_000, "")]
    items = [(1, passage, ""), (2, None, ""), (3, " ... ", ""), (None, passage, ""), (4, "the the the the the", "")]
    got = sorted((str(r.doc_id), r.item_id, r.distance, r.start_word) for r in D.contaminated(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect())
    assert got == [("3", 1, 0, 0), ("4", 1, 1, 0), ("5", 1, 0, 0), ("5", 1, 0, 50_000), ("6", 4, 0, 0), ("None", 1, 0, 0)]
    none = spark.createDataFrame([], ITEMS)
    assert D.contaminated(spark.createDataFrame(docs, DOCS), none).count() == 0
    assert D.contaminated(spark.createDataFrame([], DOCS), spark.createDataFrame(items, ITEMS)).count() == 0


def test_memory_of_a_batch_of_long_texts():
    """Only texts with a window that may match are held together, whatever the batch."""
    rng = np.random.default_rng(1)
    passage = " ".join(f"passage{i}" for i in range(30))
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 600)) for _ in range(4000)]
    texts[7], texts[9], texts[3999] = f"{texts[7]} {passage}", None, passage
    index = type("Held", (), {"value": D.ItemIndex.build([(5, passage)], 0.8, 4, 16, 2)})
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    got = [r for out in D.scan(index)(iter([batch])) for r in out.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [(r["doc_id"], r["item_id"], r["distance"], r["start_word"]) for r in got] == [(7, 5, 0, 600), (3999, 5, 0, 0)]
    assert peak < 40 << 20


@pytest.mark.parametrize("sizes", [(20_000, 300), (4 << 20, 1 << 20)])
def test_groups_of_any_size_give_the_same_rows(sizes):
    docs, items = corpus(5)
    index = type("Held", (), {"value": D.ItemIndex.build([(i, t) for i, t, _ in items], 0.8, 4, 16, 2)})
    batches = [pa.RecordBatch.from_arrays([pa.array([d[0] for d in docs[a:a + 50]], pa.int64()), pa.array([d[1] for d in docs[a:a + 50]])],
                                          ["doc_id", "text"]) for a in range(0, 160, 50)]
    got = [tuple(r.values()) for out in D.scan(index, *sizes)(iter(batches)) for r in out.to_pylist()]
    whole = index.value.match([t for _, t, _ in docs])
    assert [r[:5] for r in got] == [(docs[t][0], int(i), int(d), int(s), int(n)) for t, i, d, s, n in zip(*whole.values())]
