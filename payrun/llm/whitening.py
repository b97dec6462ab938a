"""Whitening of embeddings on their leading principal components.

Entries become integers on a fixed grid, ``x = floor(1024 c) + 100000``, and all
components are those of the covariance of ``x`` over every vector that takes part.

Spark makes three passes over the vectors: their number and sums, the products of
the centred vectors, and the covariance of the whitened ones, which is measured and
not inferred. Each task adds its rows up in one array; the arrays are added in a tree
of tasks, so the driver meets a few of them, whose size depends on the dimension
alone. Sums are exact integers (of any size), products are centred on the nearest
integers first, so they are sums of integers too and, below 2**53, the same under any
partitioning.

On the driver, spectrum slicing finds the leading eigenpairs of the d x d covariance V:

* The inertia of V - sI, from a pivoted LDL' factorization (Sylvester's law), counts
  the eigenvalues below s. Bisection on that count isolates the k-th largest one.
* Rayleigh quotient iteration from there converges cubically.
* Counts on both sides of the value found certify that it is the k-th. Values that
  double precision cannot tell apart are solved together, as one subspace: any
  orthonormal basis of it is right.

Defined results: rows whose vector is null, or holds a null, NaN or infinity take no
part; null and repeated ids are rows like all others; extra columns are not read;
vectors of several lengths, or entries beyond 2**40, are an error. Components whose
variance is zero in double precision do not exist: there are fewer than asked for in
constant, few or low-dimensional vectors, and none in an empty table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 1024, 100_000       # fixed by the contract of the grid
LARGEST = 2.0 ** 40
EPS = np.finfo(float).eps


# -- eigenpairs by spectrum slicing ------------------------------------------------

def below(matrix: np.ndarray, shift: float) -> int:
    """Number of eigenvalues below ``shift``: negative pivots of LDL' of the shifted matrix.

    Complete diagonal pivoting with pivots of one or two rows; a pivot of two rows is
    taken where the diagonal is small against the rest, and has one negative value.
    """
    a = matrix - shift * np.eye(len(matrix))
    ratio = (1 + np.sqrt(17)) / 8
    negative = 0
    while len(a):
        diagonal = np.abs(np.diagonal(a))
        p = int(np.argmax(diagonal))
        off = np.abs(a - np.diag(np.diagonal(a)))
        i, j = divmod(int(np.argmax(off)), len(a))
        if off[i, j] == 0:
            return negative + int((np.diagonal(a) < 0).sum())
        if diagonal[p] >= ratio * off[i, j]:
            rest = np.delete(np.arange(len(a)), p)
            column, pivot = a[rest, p], a[p, p]
            negative += pivot < 0
            a = a[np.ix_(rest, rest)] - np.outer(column, column) / pivot
        else:
            rest = np.delete(np.arange(len(a)), (i, j))
            columns, pivot = a[np.ix_(rest, (i, j))], a[np.ix_((i, j), (i, j))]
            negative += 1
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(pivot, columns.T)
    return int(negative)


def solve_shifted(matrix: np.ndarray, shift: float, v: np.ndarray) -> np.ndarray:
    """(V - shift I)^-1 v up to a factor, moved off the shift by a rounding error where that is singular."""
    scale = float(np.abs(matrix).max())
    for nudge in (0.0, 4 * EPS, 16 * EPS, 64 * EPS):
        try:
            w = np.linalg.solve(matrix - (shift + nudge * scale) * np.eye(len(matrix)), v)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(w).all() and w.any():
            return w / np.abs(w).max()
    raise ArithmeticError("no shift near the eigenvalue can be solved")


class Slices:
    """Counts of eigenvalues, each shift factored once."""

    def __init__(self, matrix: np.ndarray):
        self.matrix, self.known = matrix, {}
        radius = np.abs(matrix).sum(axis=1) - np.abs(np.diagonal(matrix))
        self.size = max(float(np.abs(matrix).sum(axis=1).max()), np.finfo(float).tiny)
        self.low = float((np.diagonal(matrix) - radius).min()) - EPS * 8 * self.size
        self.high = float((np.diagonal(matrix) + radius).max()) + EPS * 8 * self.size

    def above(self, shift: float) -> int:
        if shift not in self.known:
            self.known[shift] = len(self.matrix) - below(self.matrix, shift)
        return self.known[shift]

    def isolate(self, k: int) -> tuple[float, float, int, int]:
        """An interval with the k-th largest value (from 0) and the numbers (first, past
        the last) of all values in it: one alone and far from the next, or a cluster."""
        low, high = self.low, self.high
        for shift in sorted(self.known):
            if self.known[shift] > k:
                low = max(low, shift)
            else:
                high = min(high, shift)
        narrow = len(self.matrix) * EPS * self.size
        while True:
            first, past = (self.above(high) if high < self.high else 0), (self.above(low) if low > self.low else len(self.matrix))
            width = high - low
            alone = past - first == 1 and self.above(low - 10 * width) == past and self.above(high + 10 * width) == first
            middle = (low + high) / 2
            if alone or width <= 4 * narrow or not low < middle < high:
                return low, high, first, past
            if self.above(middle) > k:
                low = middle
            else:
                high = middle


def rayleigh(matrix: np.ndarray, low: float, high: float) -> tuple[float, np.ndarray]:
    """The eigenpair whose value is alone in (low, high)."""
    v = np.random.default_rng(0).standard_normal(len(matrix))
    for _ in range(5):                                      # towards the value next to the middle
        v = solve_shifted(matrix, (low + high) / 2, v)
        v /= np.linalg.norm(v)
    value, best = float(v @ matrix @ v), np.inf
    for _ in range(20):
        residual = float(np.linalg.norm(matrix @ v - value * v))
        if residual >= best:
            break
        best, kept = residual, (value, v)
        if residual <= EPS * abs(value):
            break
        v = solve_shifted(matrix, value, v)
        v = v / np.linalg.norm(v)
        value = float(v @ matrix @ v)
    return kept


def cluster(matrix: np.ndarray, low: float, high: float, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``size`` values that lie within rounding of each other, largest first."""
    basis = np.linalg.qr(np.random.default_rng(0).standard_normal((len(matrix), size)))[0]
    beside = high + 64 * EPS * float(np.abs(matrix).max())       # off the values, near them against all others
    for _ in range(6):
        basis = np.linalg.qr(solve_shifted(matrix, beside, basis))[0]
    small = basis.T @ matrix @ basis
    order = np.argsort(-np.diagonal(small), kind="stable")
    return np.diagonal(small)[order], basis[:, order]


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors (columns).

    Values not above the rounding error of the matrix are left out, by their count. Each
    value found is certified by counts: what lies above it and below it must number it as asked.
    """
    d = len(matrix)
    if not matrix.any() or not count:
        return np.empty(0), np.empty((d, 0))
    slices, values, vectors = Slices(matrix), [], []
    error = 8 * d * EPS * slices.size
    count = min(count, slices.above(error))
    while len(values) < count:
        k = len(values)
        low, high, first, past = slices.isolate(k)
        if past - first == 1:
            value, vector = rayleigh(matrix, low, high)
            found = [(value, vector)]
        else:
            value, basis = cluster(matrix, low, high, past - first)
            found = list(zip(value, basis.T))
        if slices.above(max(v for v, _ in found) + error) > first or slices.above(min(v for v, _ in found) - error) < past:
            raise ArithmeticError(f"eigenvalue {k + 1} is not certified by its counts")
        for value, vector in found[k - first:]:
            for other in vectors:
                vector = vector - (other @ vector) * other
            values.append(float(value))
            vectors.append(vector / np.linalg.norm(vector))
    return np.array(values[:count]), np.array(vectors[:count]).reshape(-1, d).T


# -- passes over the vectors -----------------------------------------------------------

@dataclass(frozen=True)
class Whitening:
    """What whitening needs of the fitted vectors; its size depends on their dimension."""

    n: int
    sums: tuple[int, ...]           # per dimension, exact
    total_variance: float
    values: np.ndarray              # falling eigenvalues
    vectors: np.ndarray             # unit eigenvectors, columns
    identity_error: float | None = None

    @property
    def explained(self) -> list[float]:
        return [float(v / self.total_variance) for v in self.values]

    def apply(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows of grid vectors."""
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole, rest = zip(*(divmod(s, self.n) for s in self.sums)) if self.n else ((), ())
        return (x - np.array(whole, np.int64)).astype(float) - np.array(rest, float) / max(self.n, 1)


def grid_vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a batch that take part, and their vectors on the grid."""
    column = batch.column(batch.num_columns - 1)
    lengths = np.diff(column.offsets.to_numpy(zero_copy_only=False))
    valid = ~column.is_null().to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)       # null entries become NaN
    lengths = np.where(valid, lengths, 0)
    row = np.repeat(np.arange(batch.num_rows), lengths)
    valid[row[~np.isfinite(flat)]] = False
    rows = np.flatnonzero(valid)
    if not len(rows):
        return rows, np.empty((0, 0), np.int64)
    if len(set(lengths[rows])) > 1:
        raise ValueError(f"vectors of several lengths: {sorted(set(map(int, lengths[rows])))[:5]}")
    entries = flat[valid[row]]
    if len(entries) and np.abs(entries).max() > LARGEST:
        raise ValueError("an entry is beyond 2**40")
    return rows, (np.floor(SCALE * entries).astype(np.int64) + OFFSET).reshape(len(rows), -1)


def added(vectors: DataFrame, measure: Callable[[np.ndarray], list[np.ndarray]]) -> list[np.ndarray] | None:
    """Sum over all vectors of ``measure`` of a block of them; None without vectors.

    One record leaves each task; a tree of tasks adds them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        total = None
        for batch in batches:
            rows, x = grid_vectors(batch)
            if len(rows):
                total = plus(total, measure(x))
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], ["total"])

    def load(row):
        import pickle

        return pickle.loads(row[0])

    parts = vectors.mapInArrow(run, "total binary").rdd.map(load)
    return parts.treeAggregate(None, plus, plus, depth=3) if parts.getNumPartitions() else None


def plus(a: list | None, b: list | None) -> list | None:
    if a is None or b is None:
        return b if a is None else a
    if any(np.shape(x) != np.shape(y) for x, y in zip(a, b)):
        raise ValueError("vectors of several lengths in the table")
    return [x + y for x, y in zip(a, b)]


def exact_sums(x: np.ndarray) -> list:
    """Number of rows and sum of each dimension, as Python integers."""
    return [len(x), x.sum(axis=0).astype(object)]


def fit(df: DataFrame, vector_col: str = "embedding", components: int = 8) -> Whitening:
    """The whitening of all vectors of ``df`` on at most ``components`` components."""
    vectors = df.select(df[vector_col].cast("array<double>"))
    found = added(vectors, exact_sums)
    if found is None:
        return Whitening(0, (), 0.0, np.empty(0), np.empty((0, 0)))
    n, sums = int(found[0]), tuple(int(s) for s in found[1])
    centre = np.array([round(Fraction(s, n)) for s in sums], np.int64)

    def products(x: np.ndarray) -> list[np.ndarray]:
        z = (x - centre).astype(float)
        return [z.T @ z]

    # about the nearest integers, so what is left of the mean is below one half
    left = np.array([float(Fraction(s, n) - int(c)) for s, c in zip(sums, centre)])
    covariance = added(vectors, products)[0] / n - np.outer(left, left)
    values, basis = leading(covariance, components)
    model = Whitening(n, sums, float(np.trace(covariance)), values, basis)
    if not len(values):
        return model

    def spread(x: np.ndarray) -> list[np.ndarray]:
        w = model.apply(x)                                  # centred: its mean is zero
        return [w.T @ w]

    error = np.abs(added(vectors, spread)[0] / n - np.eye(len(values))).max()
    return Whitening(n, sums, model.total_variance, values, basis, float(error))


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond 64 bits."""
    # Python integers where 64 bits may not hold a term or the sum
    reach = max((max(abs(n * int(a) - s), abs(n * int(b) - s)) for a, b, s in zip(x.min(axis=0), x.max(axis=0), sums)), default=0)
    kind = np.int64 if reach ** 2 * max(len(sums), 1) < 2 ** 63 and n * int(np.abs(x).max(initial=0)) < 2 ** 62 else object
    off = x.astype(kind) * n - np.array(sums, kind)
    return [v if v < 2 ** 63 else None for v in map(int, (off * off).sum(axis=1))]


def whiten(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, deviation, whitened array<double>`` of each vector that takes part."""
    kind = df.schema[id_col].dataType.simpleString()
    schema = f"vec_id {kind}, deviation long, whitened array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, x = grid_vectors(batch)
            if len(rows):
                w = model.apply(x)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(deviations(x, model.n, model.sums), pa.int64()),
                     pa.ListArray.from_arrays(np.arange(len(w) + 1, dtype=np.int32) * w.shape[1], pa.array(w.ravel()))],
                    ["vec_id", "deviation", "whitened"])

    return df.select(df[id_col], df[vector_col].cast("array<double>")).mapInArrow(run, schema)


def by_component(whitened: DataFrame, model: Whitening) -> DataFrame:
    """One row for each vector and component, with the properties of the fit."""
    share = F.array(*[F.lit(e) for e in model.explained]).cast("array<double>")
    return (whitened.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "value"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                    F.col("value").alias("whitened"), F.get(share, F.col("at")).alias("explained"),
                    F.lit(model.identity_error).cast("double").alias("identity_error")))
