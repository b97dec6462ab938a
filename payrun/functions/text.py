"""Text and number helpers, all as native Column expressions.

Each helper names its input once (``null_if_token`` twice), so that nested helpers
stay small where the optimizer merges projections and filters.

Inputs from spreadsheets arrive as text; inputs from typed tables arrive as
numbers. ``num``/``to_int`` take the Spark type of the column so that both
shapes go through the same rules without a Python UDF.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every character Python's ``str.strip()`` removes, built from Python's own
# definition of whitespace (Spark's ``trim`` only removes spaces).
WHITESPACE = "".join(chr(i) for i in range(sys.maxunicode + 1) if chr(i).isspace())

# Text accepted as a number by the source's coercion: optional sign, digits
# with an optional point, optional exponent. ``inf``/``nan`` are left out on
# purpose: non-finite amounts become 0 (see SURVEY 2.12-a).
NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace."""
    return F.btrim(col_of(c), F.lit(WHITESPACE))


def upper_strip(c) -> Column:
    return F.upper(strip(c))


def strip_cell(c) -> Column:
    """``strip`` of a stored column: a text that begins and ends in a visible ASCII
    character is taken as it is. It names the column four times."""
    c = col_of(c)
    visible = F.substring(c, 1, 1).between("!", "~") & F.substring(c, -1, 1).between("!", "~")
    return F.when(visible, c).otherwise(strip(c))


def upper_cell(c) -> Column:
    """``upper_strip`` of a stored column."""
    return F.upper(strip_cell(c))


def is_empty_cell(c: Column, tokens) -> Column:
    """True for null and for an empty-cell text (never null)."""
    tokens = list(tokens)
    return F.coalesce(c, F.lit(tokens[0])).isin(tokens) if tokens else c.isNull()


def null_if_token(c, tokens) -> Column:
    """A cell that is one of the export's empty-cell texts becomes null.

    The text is compared as it stands: blanks around a token keep it.
    """
    c = col_of(c)
    return F.when(~c.isin(list(tokens)), c) if tokens else c


def text_to_double(c) -> Column:
    """Number text -> double; anything else -> null."""
    return F.regexp_extract(strip(c), NUMBER_PATTERN, 0).try_cast("double")


def _finite_or_null(c: Column) -> Column:
    """Finite values unchanged, NaN and infinities null: the remainder by
    infinity is the value itself, or NaN where there is none."""
    return F.nanvl(c % F.lit(float("inf")), F.lit(None).cast("double"))


def num(c, dtype: T.DataType | None = None) -> Column:
    """Coerce to double; bad text, null, NaN and infinity -> 0.0."""
    c = col_of(c)
    if dtype is None or isinstance(dtype, (T.StringType, T.VarcharType, T.CharType)):
        v = text_to_double(c)
    elif isinstance(dtype, T.NullType):
        v = F.lit(None).cast("double")
    else:
        v = c.cast("double")
    return F.coalesce(_finite_or_null(v), F.lit(0.0))


def plain_int(c: Column) -> Column:
    """The integer whose own text a text is (no sign but ``-``, no zeros before it); else null."""
    n = c.try_cast("bigint")
    return F.when(n.cast("string") == c, n)


def to_int(c, dtype: T.DataType | None = None) -> Column:
    """C6, then truncate toward zero; out of range -> 0.

    Texts of integers that a double holds exactly are read without a regular expression.
    """
    c = col_of(c)
    value = F.coalesce(num(c, dtype).try_cast("bigint"), F.lit(0).cast("bigint"))
    if not (dtype is None or isinstance(dtype, T.StringType)):
        return value
    return F.coalesce(F.when(F.length(c) <= 15, plain_int(c)), value)


def dtype_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def num_col(df: DataFrame, name: str) -> Column:
    return num(F.col(name), dtype_of(df, name))


def int_col(df: DataFrame, name: str) -> Column:
    return to_int(F.col(name), dtype_of(df, name))


def as_text(c, dtype: T.DataType | None = None) -> Column:
    """Value as text for comparisons that the source does on ``str(v)``."""
    c = col_of(c)
    if dtype is None or isinstance(dtype, T.StringType):
        return c
    return c.cast("string")
