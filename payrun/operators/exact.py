"""A4: sums of any doubles, exact and in any order.

A double is an integer times a power of two, so it splits without loss into digits of
40 bits, each at a fixed place (its bin). Digits of one bin add up as whole numbers,
which no order of rows changes; at the end one short list of bins a group is joined and
rounded once. The sum is therefore the double nearest to the true one, under any
partitioning. Rows are added on each task first (one number a bin and group).

Null, NaN and infinite values count as 0, as amounts do (C6); so do values nearer to 0
than 1e-280.
"""

from __future__ import annotations

from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 40
LOWEST, HIGHEST = -24, 25           # bins of the first digit
DIGITS = 4                          # 53 bits wherever they begin in the first bin


def with_digits(df: DataFrame, x: str) -> DataFrame:
    """Adds ``_top``, the bin of the first digit of column ``x`` (null where it does not
    count), and ``_d0``, ``_d1``, ...: whole numbers, each one bin below the last."""
    size = F.abs(F.col(x))
    usable = (size > 1e-280) & (size < float("inf"))        # NaN is larger than infinity here
    top = F.least(F.greatest(F.floor(F.log2(size) / BITS), F.lit(LOWEST)), F.lit(HIGHEST)).cast("int")
    df = df.withColumn("_top", F.when(usable, top)).withColumn("_rest", F.col(x))
    for i in range(DIGITS):
        df = df.withColumn("_unit", F.pow(F.lit(2.0), ((F.col("_top") - i) * BITS).cast("double")))
        df = df.withColumn("_scaled", F.when(F.col("_unit") > 0, F.col("_rest") / F.col("_unit")))
        df = df.withColumn(f"_d{i}", F.when(F.col("_scaled") < 0, F.ceil("_scaled")).otherwise(F.floor("_scaled")))
        df = df.withColumn("_rest", F.col("_rest") - F.col(f"_d{i}").cast("double") * F.col("_unit"))
    return df


def exact_sums(df: DataFrame, keys: list[str], columns: list[str], unit_bits: int | None = None) -> DataFrame:
    """``keys..., sum_<column>...``: exact sums of double columns, 0.0 where nothing counts.

    With ``unit_bits`` sums come as the text of the whole number of units of
    2**-unit_bits, rounded to even, instead of doubles. Each digit is added in two halves
    of 20 bits, as longs: 2**43 rows of a group fit.
    """
    values = F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("x")) for i, c in enumerate(columns)])
    one = with_digits(df.select(*keys, F.explode(values).alias("v")).select(*keys, F.col("v.i").alias("i"), F.col("v.x").alias("_x")), "_x")
    halves = {f"_d{k}": (F.shiftright(f"_d{k}", 20), F.col(f"_d{k}").bitwiseAND(F.lit((1 << 20) - 1).cast("bigint"))) for k in range(DIGITS)}
    parts = one.groupBy(*keys, "i", "_top").agg(*[F.sum(half).alias(f"{d}_{h}") for d, both in halves.items() for h, half in enumerate(both)])
    added = [F.struct((F.col("_top") - k).alias("bin"), (F.col(f"_d{k}_0").cast("decimal(20,0)") * (1 << 20) + F.col(f"_d{k}_1")).cast("string").alias("total"))
             for k in range(DIGITS)]
    found = parts.select(*keys, "i", F.filter(F.array(*added), lambda b: b["bin"].isNotNull() & b["total"].isNotNull()).alias("bins"))
    joined = found.groupBy(*keys).agg(*[F.flatten(F.collect_list(F.when(F.col("i") == i, F.col("bins")))).alias(f"_b{i}") for i in range(len(columns))])
    join = total_units(unit_bits) if unit_bits is not None else total
    return joined.select(*keys, *[join(F.transform(f"_b{i}", lambda b: b["bin"]), F.transform(f"_b{i}", lambda b: b["total"])).alias(f"sum_{c}")
                                  for i, c in enumerate(columns)])


def whole(bins, totals) -> Fraction:
    """The true sum of one group's bins."""
    return sum((int(t) * Fraction(2) ** (BITS * int(b)) for b, t in zip(bins, totals)), Fraction(0))


def nearest(value: Fraction) -> float:
    try:
        return float(value)
    except OverflowError:
        return float("inf") if value > 0 else float("-inf")


@F.pandas_udf(T.DoubleType())
def total(bins: pd.Series, totals: pd.Series) -> pd.Series:
    """Bins of a group as the nearest double (a few bins a group: the rows are added by then)."""
    return pd.Series([nearest(whole(b, t)) for b, t in zip(bins, totals)], dtype="float64")


def total_units(bits: int):
    @F.pandas_udf(T.StringType())
    def units(bins: pd.Series, totals: pd.Series) -> pd.Series:
        return pd.Series([str(round(whole(b, t) * 2 ** bits)) for b, t in zip(bins, totals)], dtype="object")
    return units
