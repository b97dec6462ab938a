"""Step 1 and step 2 of a payment run, as single lazy plans.

step 1: cleaned invoices -> rates (J4) -> D1-D6 -> area (J1-J3, D7) -> D8-D16
step 2: a processed table (as staged by step 1, or not derived yet) -> its rows with
        their rates -> the warehouse shape (P3-P11); payrun.sinks loads it (K4)

Each function takes and returns DataFrames; nothing is collected. Batches
are a column, so one plan handles every batch of a run together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..operators import areas as A
from ..operators import clean as C
from ..operators import derive as D
from ..operators import publish as P
from ..operators import rates as RT
from ..rules import DEFAULT_RULES, PayRules
from ..session import compiled_apart

# Columns whose presence means a table was already derived.
PROCESSED_MARKERS = ("moneda_pago", "monto_final", "area")


def derive_all(df: DataFrame, areas: DataFrame, rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """J1, C10 and D1-D16 over filtered rows that carry the rate columns.

    Both joins (rates before this call, the area lookup here) come before
    any projection that rewrites many columns: the C10 token nulling and
    the D-chain sit above every join, so the optimizer never infers join
    constraints through them (with 14 rewritten text columns below a join
    that inference grows exponentially). The lookup key is token-aware on
    its own, so the result equals nulling tokens first.

    The steps are compiled apart: one method for all would be interpreted.
    """
    text_cols = [c for c in df.columns if c in R.INPUT_COLUMNS
                 and df.schema[c].dataType.simpleString() == "string"]
    df = A.attach_area_lookup(df, areas, rules)
    df = compiled_apart(C.null_tokens(df, rules, cols=text_cols))
    df = compiled_apart(D.derive_payment(df, rules))
    df = compiled_apart(A.derive_area(df, rules))
    return compiled_apart(D.derive_capex(df))


def step1(invoices: DataFrame, areas: DataFrame, rates: DataFrame,
          rules: PayRules = DEFAULT_RULES, key: str = "batch_id") -> DataFrame:
    """Drop empty and summary rows, attach each batch's rates, derive."""
    df = C.drop_rows(D.ensure_inputs(invoices), rules)
    df = RT.attach_rates(df, rates, key, rules)
    return derive_all(df, areas, rules)


def canonical_names() -> dict[str, str]:
    """Every name that a sheet may give a column, without case, and the column it means."""
    display = dict(R.DISPLAY_TO_COLUMN)
    names = {c: c for c in (*R.INPUT_COLUMNS, *R.DERIVED_COLUMNS)}
    names |= dict(R.HEADER_TO_COLUMN) | {old: display[new] for old, new in R.RENAME_OUTPUT} | display
    return {name.casefold(): column for name, column in names.items()}


def resolve_names(df: DataFrame) -> DataFrame:
    """A sheet's display names (P1) as the package's names, at plan time.

    Names are cleaned (C3) and compared without case. Unknown columns keep theirs; of
    several columns that mean the same the first one counts.
    """
    known, taken, out = canonical_names(), set(), []
    for i, name in enumerate(df.columns):
        column = known.get(C.clean_name(name).casefold(), name)
        if column not in taken:
            taken.add(column)
            out.append(F.col(f"_{i}").alias(column))
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))]).select(*out)


def processed_already(df: DataFrame) -> bool:
    """The table has the derived columns (plan-time test, no job)."""
    return set(PROCESSED_MARKERS) <= set(df.columns)


def step2(table: DataFrame, areas: DataFrame, rates: DataFrame,
          rules: PayRules = DEFAULT_RULES, key: str = "batch_id") -> DataFrame:
    """Derive only when needed, then keep the rates on the rows.

    A processed table (canonical or display names) is cleaned again, as the source
    does, and gets its batch's stored rate snapshot (Q7: one snapshot per batch, not
    a new fetch); a raw one goes through step 1. Cleaning is compiled apart, so filters
    that should prune batches belong on ``table``.
    """
    table = resolve_names(table)
    if processed_already(table):
        df = compiled_apart(C.clean(table, rules))
        return RT.attach_rates(df.drop(*[c for c in R.RATE_COLUMNS if c in df.columns]),
                               rates, key, rules)
    return step1(table, areas, rates, rules, key)


def step2_shape(table: DataFrame, areas: DataFrame, rates: DataFrame, run_ts: Column | None = None,
                rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """Step 2 to its end: the warehouse shape (P3-P11) of a sheet as step 1 staged it, or
    of a raw one. ``sinks.warehouse.load`` loads it, ``sinks.files.write_run`` keeps it.
    Cleaning and shape are compiled apart."""
    return P.warehouse_shape(compiled_apart(step2(table, areas, rates, rules)), run_ts, rules)
