import hashlib
import os
import random

import pytest

from payrun.llm import suffix_index as S
from payrun.llm.queries import op6_suffix_index

SCHEMA = "doc_id long, text string, cut string"


def brute(rows, length):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        gone = [False] * len(data)
        for s in range(len(data) - length + 1):
            w = data[s:s + length]
            if w in seen:
                gone[s:s + length] = [True] * length
            seen.add(w)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def run(spark, rows, **kw):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], SCHEMA).repartition(3)
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(docs, **kw).collect()}


def corpus(seed):
    rng = random.Random(seed)

    def text(n):
        return "".join(rng.choices("abcdefgh é", k=n))

    passages = [text(rng.randint(60, 260)) for _ in range(6)]
    rows = []
    for i in range(40):
        body = [text(rng.randint(0, 200))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a = rng.randint(0, 40)
            body += [p[a:], text(rng.randint(0, 60))]
        rows.append((i * 3, "".join(body)))
    rows += [(200, None), (201, ""), (202, "a" * 99), (203, "a" * 450), (204, "a" * 100), (205, "ab" * 120), (206, rows[5][1]),
             (207, rows[5][1] + rows[6][1]), (208, ("x" * 50 + "yz" * 40) * 4)]
    return rows


@pytest.mark.parametrize("batches, hot_rows", [(1, 20_000), (4, 20_000), (3, 2), (16, 20_000)])
def test_equal_to_brute_force(spark, batches, hot_rows):
    rows = corpus(batches)
    assert run(spark, rows, batches=batches, hot_rows=hot_rows) == brute(rows, 100)


def test_levels_merge_geometrically(spark):
    family = S.SuffixFamily()
    docs = spark.createDataFrame([(i, f"{i} " * 90) for i in range(5)], "doc_id long, text string")
    sizes = []
    for i in range(5):
        family.add(docs.where(f"doc_id = {i}"))
        sizes.append([n for n, _, _ in family.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]


def test_empty_and_repeated_rows(spark):
    assert run(spark, []) == {}
    assert run(spark, [(1, "")])[1][:3] == (0, 0, 0)
    same = "one two three " * 10
    got = run(spark, [(1, same), (1, same), (None, same), (2, same)], batches=1)
    assert got[2][1] == len(same) and got[None][1] == 0 and got[1] == brute([(1, same)], 100)[1]


def test_very_long_text(spark):
    rng = random.Random(7)
    long = "".join(rng.choices("abcdefgh ", k=250_000))
    rows = [(1, long), (2, "x" + long[1_000:1_099]), (3, "y" + long[200_000:200_100] + "z"), (4, long[5:] + long[:90]), (5, "é" * 60_000)]
    assert run(spark, rows) == brute(rows, 100)


def test_arrays_are_in_byte_order_and_superseded_ones_are_deleted(spark):
    family = S.SuffixFamily()
    paths = []
    for i in range(3):
        family.add(spark.createDataFrame([(i, f"{i} word " * 60)], "doc_id long, text string"))
        paths.append(family.levels[-1][1])
    assert [n for n, _, _ in family.levels] == [2, 1]
    assert not os.path.exists(paths[0]) and os.path.exists(paths[1]) and os.path.exists(paths[2])
    rows = [(r.p1, r.p2, r.p3, r.around) for r in S.suffixes(spark.createDataFrame([(1, "some words of a text " * 3 + "é" * 90)], "doc_id long, text string"), 100)
            .where("at >= 0").sort(*S.NAMES).collect()]
    texts = [b"".join(((p ^ (-1 << 63)) & (2**64 - 1)).to_bytes(8, "big") for p in r[:3]) for r in rows]
    whole = ("some words of a text " * 3 + "é" * 90).encode()
    assert texts == sorted(texts) and all(t in whole for t in texts)


def test_registered_query_on_a_given_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    got = op6_suffix_index(spark, sf_dir)
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_removed", "bigint"), ("n_spans", "bigint"), ("kept_sha256", "string")]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == brute([tuple(d) for d in docs], 100)


def test_combining_more_often_keeps_every_first_suffix(spark):
    docs = spark.createDataFrame(corpus(5)[:20], "doc_id long, text string").where("text is not null").coalesce(1)
    once, often = (S.suffixes(docs, 100, n).where("at >= 0") for n in (1_000_000, 30))
    first = {tuple(r) for r in once.collect()}
    assert first and first <= {tuple(r) for r in often.collect()}
