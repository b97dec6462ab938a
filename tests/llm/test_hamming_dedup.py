import random
import re

import numpy as np
import pytest

from payrun.llm import hamming_dedup as H
from payrun.llm.components import components
from payrun.llm.shingles import WordHashes, shingle_set, words_of

SCHEMA = "doc_id long, text string, component_id string, n string"


def shingles(text, n):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    return set() if not w else {tuple(w)} if len(w) < n else {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def brute(rows, n):
    sets = [shingles(t, n) for _, t in rows]
    comp = list(range(len(rows)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                comp[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: (len(s), low[find(i)], d == low[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets))}


def run(spark, rows, n=2, **kw):
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in H.near_duplicates(docs, n=n, **kw).collect()}


def corpus(seed, families=12, copies=14, chain=True):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(families):
        base = rng.choices(vocab, k=rng.randint(30, 200))
        for c in range(copies):
            text = list(base)
            for _ in range(rng.randint(0, len(base) // 12)):
                text[rng.randrange(len(text))] = rng.choice(vocab)
            rows.append(" ".join(text))
            if chain and c % 3 == 0:
                base = text             # drift, so that links form chains
    rows += ["", "  ", "one", "ONE", "one two", "one  Two", "É", "é", "same same same same", "same same"] + [rows[3]] * 20
    rng.shuffle(rows)
    return [(i * 7 % 1009, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("n, blocks", [(2, {}), (5, {}), (2, {"bucket_block": 3, "family_block": 4})])
def test_classes_equal_brute_force(spark, n, blocks):
    rows = corpus(n)
    assert run(spark, rows, n, **blocks) == brute(rows, n)


def test_signatures_within_the_radius_always_share_a_bucket():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 256, (300, H.CHUNKS * H.WIDTH)).astype(np.uint8)
    b = a.copy()
    for row in b:
        at = rng.choice(len(row), H.RADIUS, replace=False)
        row[at] ^= rng.integers(1, 256, len(at)).astype(np.uint8)
    assert (H.bucket_keys(a) == H.bucket_keys(b)).any(axis=1).all()


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "a b c"), (4, "A B C"), (None, "a b c"), (5, "x " * 50_000), (6, "x " * 50_001)]
    got = run(spark, rows)
    assert got == {1: (0, 1, True), 2: (0, 2, True), 3: (2, 3, True), 4: (2, 3, False), None: (2, None, True),
                   5: (1, 5, True), 6: (1, 5, False)}
    assert run(spark, []) == {}
    assert run(spark, [(1, "a b"), (1, "a b"), (1, "q r s")])[1][1:] == (1, True)


def test_words_and_shingles():
    text = "A\x1fb\u00a0C d\x0be É\u2003f \x85 g"
    assert len(shingle_set(words_of(text), 2, WordHashes())) == len(shingles(text, 2))


def test_components_of_a_long_path(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    edges = [(a, b) for a, b in zip(order, order[1:])] + [(900, 901), (901, 902), (900, 900)]
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(200)) and {got[i] for i in (900, 901, 902)} == {900}
