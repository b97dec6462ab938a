import numpy as np
import pytest
from pyspark.sql import functions as F

from payrun.llm import queries, whitening


def same_pairs(matrix, count):
    """Eigenpairs against numpy's, up to signs and the choice within equal values."""
    values, vectors = whitening.leading(matrix, count)
    size = np.abs(matrix).sum(axis=1).max(initial=0)
    want = np.linalg.eigvalsh(matrix)[::-1][:count]
    want = want[want > 8 * len(matrix) * whitening.EPS * size]
    assert len(values) == len(want)
    if len(want):
        assert np.abs(values - want).max() <= 1e-13 * size
        assert np.abs(vectors.T @ vectors - np.eye(len(want))).max() < 1e-13
        assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-13 * size


def rotated(spectrum, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(spectrum),) * 2))[0]
    v = q @ np.diag(spectrum) @ q.T
    return (v + v.T) / 2


@pytest.mark.parametrize("matrix", [
    np.zeros((4, 4)), np.eye(5), np.eye(6) * 1e-30, np.array([[2.0]]), np.array([[0, 1], [1, 0.0]]), np.diag([3, 3, 2, 1, 1, 0.0]),
    rotated([5] * 6 + [4] * 6 + [1] * 28), rotated([5, 5 - 1e-9, 5 - 1e-12, 4, 4 - 1e-14, 3] + [1e-6] * 34), rotated([1e8, 1, 1e-8, 1e-9]),
    np.outer(range(30), range(30)).astype(float), rotated(list(np.linspace(1, 9, 64)))])
def test_spectrum_slicing(matrix):
    same_pairs(matrix, 8)


def test_random_covariances_and_counts():
    rng = np.random.default_rng(4)
    for _ in range(150):
        d = int(rng.integers(1, 12))
        a = rng.integers(-3, 4, (d, d)).astype(float)
        same_pairs(a @ a.T, 8)
        for shift in rng.standard_normal(3) * 5:
            assert whitening.below(a + a.T, shift) == (np.linalg.eigvalsh(a + a.T) < shift).sum()


def brute(rows, components=8):
    """The contract in plain numpy: {id: (deviation, whitened)} , explained, n."""
    kept = [(i, np.array(v, float)) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([np.floor(1024 * v).astype(np.int64) + 100000 for _, v in kept])
    n, sums = len(x), [int(s) for s in x.sum(axis=0)]
    y = x - np.array(sums) / n
    v = y.T @ y / n
    e, p = np.linalg.eigh(v)
    e, p = e[::-1][:components], p[:, ::-1][:, :components]
    deviation = [sum((n * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x]
    return [i for i, _ in kept], deviation, y @ p / np.sqrt(e), e / np.trace(v), n


def compared(got, rows, components=8):
    ids, deviation, white, explained, n = brute(rows, components)
    k = white.shape[1]
    assert len(got) == len(ids) * k
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    w = np.array([[by_id[i][c + 1].whitened for c in range(k)] for i in ids])
    signs = np.sign((w * white).sum(axis=0))
    assert np.abs(w * signs - white).max() < 1e-8
    for i, d in zip(ids, deviation):
        assert {r.deviation for r in by_id[i].values()} == {d} and {r.n for r in by_id[i].values()} == {n}
    assert np.allclose([by_id[ids[0]][c + 1].explained for c in range(k)], explained, rtol=1e-9)
    error = {r.identity_error for r in got}
    assert len(error) == 1 and error.pop() < 1e-9


def whitened(df, components=8):
    model = whitening.fit(df, components=components)
    return whitening.by_component(whitening.whiten(df, model), model).collect()


@pytest.mark.parametrize("parts", [1, 5])
def test_equals_brute_force(spark, parts):
    rng = np.random.default_rng(1)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.standard_normal((200, 12)) * np.linspace(1, 5, 12))]
    rows += [(900, None), (901, [None] + [1.0] * 11), (902, [float("nan")] * 12), (903, [float("inf")] + [0.0] * 11)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, component int, n string").repartition(parts)
    compared(whitened(df), rows)
    compared(whitened(df, 3), rows, 3)


def test_few_repeated_and_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitened(spark.createDataFrame([], schema)) == []
    assert whitened(spark.createDataFrame([(1, None), (2, [float("nan")])], schema)) == []
    assert whitened(spark.createDataFrame([(1, [0.5, 0.25])] * 3, schema)) == []            # no variance: no component
    got = whitened(spark.createDataFrame([(1, [0.0, 0.0]), (1, [1.0, 1.0]), (None, [1.0, 1.0]), (None, [0.0, 0.0])], schema))
    assert sorted((r.component, abs(round(r.whitened, 9)), r.deviation) for r in got) == [(1, 1.0, 2 * 2048 ** 2)] * 4
    with pytest.raises(Exception, match="several lengths"):
        whitening.fit(spark.createDataFrame([(1, [0.5]), (2, [0.5, 0.25])], schema).coalesce(1))
    with pytest.raises(Exception, match="several lengths"):
        whitening.fit(spark.createDataFrame([(1, [0.5]), (2, [0.5, 0.25])], schema).repartition(2, "vec_id"))


def test_deviations_beyond_64_bits():
    x = np.array([[2 ** 40], [-2 ** 40]])
    assert whitening.deviations(x, 2, (0,)) == [None, None]
    assert whitening.deviations(np.array([[3, 1], [-3, 0]]), 2, (0, 1)) == [37, 37]
    assert whitening.deviations(np.array([[2 ** 20], [-2 ** 20]]), 1000, (0,)) == [(1000 << 20) ** 2] * 2


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.op11_whitening(spark, sf)
    assert got.dtypes == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"),
                          ("explained", "double"), ("identity_error", "double")]
    compared(got.collect(), rows)


def test_driver_holds_nothing_that_grows_with_rows(spark):
    """The arrays that reach the driver are of the dimension's size, whatever the rows."""
    df = spark.range(5000).select(F.array(*[F.rand(i) for i in range(3)]).alias("embedding"))
    n, sums = whitening.added(df, whitening.exact_sums)
    assert n == 5000 and np.shape(sums) == (3,)
