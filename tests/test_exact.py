import math
import random
from fractions import Fraction

import pytest

from payrun.operators import exact
from payrun.operators import summary as S


def true_sum(values):
    return float(sum((Fraction(v) for v in values if v is not None and math.isfinite(v)), Fraction(0)))


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_sums_are_those_of_fractions(spark, parts):
    pick = random.Random(7)
    groups = {
        "mixed": [1e25, 1e-12, -1e25, 1e-12, 0.1, -0.1, 3.0],
        "cents": [round(pick.uniform(-1e6, 1e6), 2) for _ in range(500)],
        "wide": [pick.choice([-1, 1]) * pick.random() * 10.0 ** pick.randint(-270, 300) for _ in range(400)],
        "powers": [2.0 ** k for k in range(-900, 1000, 7)] + [-(2.0 ** k) for k in range(-900, 900, 7)],
        "edges": [2.0 ** 40, 2.0 ** 40 - 1, -(2.0 ** 80), 2.0 ** 80 + 2.0 ** 28, 1.7976931348623157e308, -1.7976931348623157e308, 5e-13],
        "none": [None, float("nan"), float("inf"), 0.0, -0.0],
    }
    df = spark.createDataFrame([(k, v, None if v is None else -v) for k, vs in groups.items() for v in vs], "k string, a double, b double").repartition(parts)
    got = {r.k: (r.sum_a, r.sum_b) for r in exact.exact_sums(df, ["k"], ["a", "b"]).collect()}
    assert got == {k: (true_sum(vs), true_sum([None if v is None else -v for v in vs])) for k, vs in groups.items()}


def test_units_and_empty_table(spark):
    df = spark.createDataFrame([("x", 0.5), ("x", 0.25), ("x", -1e20)], "k string, a double")
    assert [r.sum_a for r in exact.exact_sums(df, ["k"], ["a"], unit_bits=2).collect()] == [str(3 - 4 * 10 ** 20)]
    assert exact.exact_sums(df.where("false"), ["k"], ["a"]).collect() == []


def test_a_large_amount_does_not_end_the_summary(spark):
    df = spark.createDataFrame([("b", 1e20, 1.5, None, 2.0), ("b", 1.0, 2.5, 1.0, 2.0), ("c", 1.0, 2.0, 3.0, 4.0)],
                               "batch_id string, monto double, monto_capex_ext double, monto_capex_ord double, monto_cadm double")
    got = {r.batch_id: r for r in S.amount_sums(df).collect()}
    assert got["b"].sum_monto is None and got["b"].sum_monto_capex_ext == 4 and got["c"].sum_monto == 1
    sums = {r.batch_id: r.sum_monto for r in S.exact_amount_sums(df).collect()}
    assert sums == {"b": 1e20 + 1, "c": 1.0}
