"""Cleaning of invoice rows and column names.

All row operations are filters or projections (no shuffle). The only
step that needs an action is C2 (which columns are entirely empty); it runs
one aggregate and is meant for wide inputs with unknown columns only.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules as R
from ..functions import text
from ..rules import DEFAULT_RULES, PayRules

KEY_COLUMNS = ("batch_id", "row_idx")


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in KEY_COLUMNS]


# -- names (C3, C4) ------------------------------------------------------------

def clean_name(name) -> str:
    """C3 for one name: strip, newline -> space, drop carriage returns."""
    return str(name).strip().replace("\n", " ").replace("\r", "")


def clean_name_col(c: Column) -> Column:
    """C3 as a Column, for header cells held in an array."""
    return F.replace(F.replace(text.strip(c), F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(""))


def clean_names(df: DataFrame) -> DataFrame:
    """C3 + C4: cleaned names; columns named ``Unnamed*`` are dropped."""
    names = [clean_name(c) for c in df.columns]
    df = df.toDF(*names)
    return df.select([F.col(f"`{c}`") for c in names if not c.startswith("Unnamed")])


# -- values (C10, C6, C7) --------------------------------------------------------

def null_tokens(df: DataFrame, rules: PayRules = DEFAULT_RULES,
                cols: list[str] | None = None) -> DataFrame:
    """Empty-cell texts of text columns become null."""
    cols = cols if cols is not None else [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in KEY_COLUMNS]
    return df.withColumns({c: text.null_if_token(F.col(c), rules.null_tokens) for c in cols})


def coerce_numbers(df: DataFrame, cols=R.AMOUNT_COLUMNS) -> DataFrame:
    """Amounts as doubles; bad text, null and non-finite -> 0."""
    return df.withColumns({c: text.num_col(df, c) for c in cols if c in df.columns})


def coerce_priority(df: DataFrame, col: str = "prioridad") -> DataFrame:
    """Priority as an integer (C6, then truncation toward zero)."""
    return df.withColumn(col, text.int_col(df, col)) if col in df.columns else df


# -- rows (C1, C5) ----------------------------------------------------------------

def all_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNull() for c in cols], F.lit(True))


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows whose data columns are all null."""
    return df.dropna(how="all", subset=data_columns(df))


def is_summary_row(df: DataFrame, rules: PayRules = DEFAULT_RULES) -> Column:
    """C5 test: invoice number holds a summary text (null -> not summary).

    One regular expression reads the stripped, upper-cased text once (a
    filter does not share sub-expressions between its terms).
    """
    u = text.upper_strip(text.as_text(F.col("numero_factura"), text.dtype_of(df, "numero_factura")))
    pattern = "|".join([re.escape(t) for t in rules.summary_row_contains]
                       + ["^" + re.escape(rules.summary_row_equals) + "$"])
    return F.coalesce(u.rlike(pattern), F.lit(False))


def drop_summary_rows(df: DataFrame, rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """Drop the sheet's total lines."""
    if "numero_factura" not in df.columns:
        return df
    return df.where(~is_summary_row(df, rules))


def empty_after_tokens(df: DataFrame, rules: PayRules = DEFAULT_RULES) -> Column:
    """C1 test on raw values: every data cell is null or an empty-cell text."""
    tests = []
    for f in df.schema.fields:
        if f.name in KEY_COLUMNS:
            continue
        c = F.col(f"`{f.name}`")
        tests.append(text.is_empty_cell(c, rules.null_tokens)
                     if isinstance(f.dataType, T.StringType) else c.isNull())
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def drop_rows(df: DataFrame, rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """C1 + C5 on raw cells (token-aware); C10 is left to the caller.

    One filter on stored columns: filters put above it (a batch, say) still reach the
    scan and prune its partitions.
    """
    keep = ~empty_after_tokens(df, rules)
    if "numero_factura" in df.columns:
        keep = keep & ~is_summary_row(df, rules)
    return df.where(keep)


def clean(df: DataFrame, rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """C10 + C1 + C5 over a named invoice table (K9's data).

    The row filter reads the raw cells (token-aware) and the C10 projection
    comes after it: the filter then shares no expression with the
    projection's aliases, which keeps Catalyst's constraint inference
    linear in the number of columns (a filter over aliased CASE columns
    makes it exponential).
    """
    return null_tokens(drop_rows(df, rules), rules)


# -- columns (C2) ---------------------------------------------------------------------

def empty_columns(df: DataFrame) -> DataFrame:
    """C2 measure: non-null count per data column, one row per batch."""
    cols = data_columns(df)
    keys = [k for k in ("batch_id",) if k in df.columns]
    return df.groupBy(*keys).agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in cols])


def drop_empty_columns(df: DataFrame, keep=R.EXPECTED_HEADERS + R.INPUT_COLUMNS) -> DataFrame:
    """Drop columns with no value at all unless they are expected.

    Runs one aggregate job (a single row comes back to the driver).
    """
    cols = data_columns(df)
    if not cols:
        return df
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(cols)]).first()
    empty = [c for i, c in enumerate(cols) if counts[f"c{i}"] == 0 and c not in keep]
    return df.drop(*empty) if empty else df


def removed_rows(df: DataFrame, rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """Per batch, rows that C1 (empty) and C5 (summary) remove, in one pass."""
    tok = null_tokens(df, rules)
    empty = all_null(data_columns(tok))
    summary = ~empty & is_summary_row(tok, rules)
    return tok.groupBy("batch_id").agg(
        F.count("*").alias("rows_in"),
        F.count_if(empty).alias("empty_rows"),
        F.count_if(summary).alias("summary_rows"),
    )
