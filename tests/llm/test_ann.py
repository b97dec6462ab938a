import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from payrun.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, every, k):
    ok = {(i, v) for i, v, _ in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in ok:
        if i % every == 0:
            a = np.array(v, float)
            near = sorted((-round(float((a * np.array(w)).sum() / np.sqrt((a * a).sum()) / np.sqrt((np.array(w, float) ** 2).sum())), 12), j)
                          for j, w in ok if j != i)[:k]
            out[i] = [(j, -s) for s, j in near]
    return out


def found(spark, rows, every=5, **kw):
    got = {}
    for r in ann.search(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % every == 0, **kw).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


def same(got, want):
    assert got.keys() == {q for q, near in want.items() if near}
    for q, near in got.items():
        assert [j for j, _ in near] == [j for j, _ in want[q]]
        assert np.allclose([s for _, s in near], [s for _, s in want[q]], rtol=0, atol=1e-12)


def test_exact_where_all_lists_are_probed(spark):
    rng = np.random.default_rng(1)
    rows = [(i, tuple(map(float, rng.normal(size=6).astype(np.float32))), "clash") for i in range(300)]
    rows += [(i, rows[7][1], "") for i in range(300, 340)] + [(340, None, ""), (341, (0.0,) * 6, ""), (342, (1.0, None, 1.0, 1.0, 1.0, 1.0), ""),
             (343, (float("nan"),) * 6, ""), (344, (float("inf"),) * 6, ""), (345, (), ""), (None, rows[3][1], ""), rows[10], (350, (1.0, 2.0), "")]
    want = brute([r for r in rows if r[0] != 350], 5, 5)
    same(found(spark, rows, list_rows=20, least_probes=99, probe_ratio=99, block_rows=16), want)


def test_tiny_and_empty_tables(spark):
    assert found(spark, []) == {}
    assert found(spark, [(0, (1.0, 2.0), "")]) == {}
    assert found(spark, [(0, None, ""), (5, (0.0, 0.0), "")]) == {}
    got = found(spark, [(0, (1.0, 0.0), ""), (1, (0.0, 1.0), ""), (2, (1.0, 1.0), "")])
    assert [j for j, _ in got[0]] == [2, 1]


@pytest.mark.parametrize("k", [40, 700])
def test_graph_search_finds_near_centroids(k):
    rng = np.random.default_rng(2)
    points = ann.unit(rng.normal(size=(k, 16)))
    x = ann.unit(rng.normal(size=(200, 16)))
    ids, _ = ann.Centroids.build(points).search(x, 24)
    best = np.argsort(-(x @ points.T), axis=1)[:, :5]
    assert np.mean([len(set(a) & set(b)) / 5 for a, b in zip(ids, best)]) > 0.95


def test_recall_on_the_small_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, tuple(r.embedding), "") for r in table.collect()]
    want = brute(rows, 50, 5)
    got = found(spark, rows, every=50)
    assert np.mean([len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / 5 for q in want]) >= 0.9


def test_every_query_gets_k_rows(spark):
    """Outliers and groups of near copies have lists of their own, which hold fewer than k."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 24))[rng.integers(0, 40, 1500)] + 0.15 * rng.normal(size=(1500, 24))
    x[::25] = 8 * rng.normal(size=(60, 24))                                        # outliers
    for a in range(5, 1500, 100):                                                  # groups of 3
        x[a:a + 3] = rng.normal(size=24) + 1e-4 * rng.normal(size=(3, 24))
    rows = [(i, tuple(map(float, v.astype(np.float32))), "") for i, v in enumerate(x)]
    rows += [(1500 + i, rows[25 * i][1], "") for i in range(2)]                    # an outlier given twice
    want = brute(rows, 5, 5)
    for least in (1, 48):                            # 1: the lists alone hold too few
        got = found(spark, rows, list_rows=8, sample=1502, least_probes=least)
        assert {q: len(near) for q, near in got.items()} == {q: 5 for q in want}
    assert np.mean([len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / 5 for q in want]) >= 0.9


def test_ties_beyond_the_block_cut_go_to_smaller_ids(spark):
    """Binary vectors and multiples of one vector: many tie at the last place."""
    rng = np.random.default_rng(4)
    binary = {tuple(map(float, v)) for v in rng.integers(0, 2, (500, 9)) if v.any()}
    one = rng.normal(size=9).astype(np.float32)
    scaled = [tuple(map(float, m * one.astype(float))) for m in range(1, 60)]
    vecs = sorted(binary) + scaled
    rows = [(int(i), v, "") for i, v in zip(rng.permutation(len(vecs)), vecs)]
    table = spark.createDataFrame(rows, SCHEMA.replace("float", "double"))
    got = {}
    for r in ann.search(table, F.col("vec_id") % 5 == 0, least_probes=99).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    same(got, brute(rows, 5, 5))


def test_recall_where_lists_are_left_out(spark):
    """About 50,000 vectors without clear groups: a third of all lists is probed."""
    rng = np.random.default_rng(6)
    x = (rng.normal(size=(50_000, 24)) + rng.normal(size=(40, 24))[rng.integers(0, 40, 50_000)]).astype(np.float32)
    table = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": x.tolist()}), "vec_id long, embedding array<float>").repartition(8)
    got = {}
    for r in ann.search(table, F.col("vec_id") % 500 == 0, sample=5000).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    recall = []
    for q in range(0, len(x), 500):
        near = np.argsort(-(u @ u[q]), kind="stable")
        recall.append(len(got[q] & set(near[near != q][:5].tolist())) / 5)
    assert len(got) == 100 and np.mean(recall) >= 0.9


def test_a_shard_that_many_queries_probe_is_split(spark):
    rng = np.random.default_rng(7)
    rows = [(i, tuple(map(float, rng.normal(size=5).astype(np.float32))), "") for i in range(400)]
    same(found(spark, rows, every=2, list_rows=20, least_probes=99, shard_rows=30, least_shards=1, shard_queries=7), brute(rows, 2, 5))
