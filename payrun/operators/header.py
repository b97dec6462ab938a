"""H1-H5: find each sheet's header row and turn grid rows into named columns.

Input is a grid ``(batch_id, row_idx, cells array<string>)``. Detection
looks only at rows with ``row_idx`` below the search limit, so it is a
filter (pushed to the scan for parquet grids) plus one small aggregate per
batch: the first row with enough expected names (H1), else the first row
that looks like a text header (H2), else the first row (H3). All three are
found in the same pass with ``min_by``.

Promotion (H4) joins each grid row to its batch's header (one row per batch, broadcast
where its measured size allows, salted beyond) and reads every expected column by its
position in the cleaned header. Positions are searched once per batch, not per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import text
from ..rules import DEFAULT_RULES, PayRules
from ..session import compiled_apart, stored
from . import clean as C
from .keyed import join_keyed


def header_hits(cells: Column, rules: PayRules = DEFAULT_RULES) -> Column:
    """H1 score: cells whose stripped text is an expected header."""
    expected = list(rules.expected_headers)
    return F.size(F.filter(cells, lambda x: text.strip(x).isin(expected)))


def nonblank_cells(cells: Column) -> Column:
    return F.filter(cells, lambda x: x.isNotNull() & (text.strip(x) != ""))


def looks_like_header(cells: Column, rules: PayRules = DEFAULT_RULES) -> Column:
    """H2 test: enough non-blank cells, at least a share of them text.

    A cell is text when it does not read as a number (the grid holds text
    only, so this stands in for the spreadsheet's cell type).
    """
    nb = nonblank_cells(cells)
    n = F.size(nb)
    t = F.size(F.filter(nb, lambda x: text.text_to_double(x).isNull()))
    return (n >= rules.fallback_min_cells) & (t >= n * F.lit(rules.fallback_text_share))


def header_names(cells: Column) -> Column:
    """H5 + C3: header texts as names: cleaned, ``Unnamed: i`` for blanks."""
    return F.transform(cells, lambda x, i: F.when(
        x.isNull() | (text.strip(x) == ""), F.concat(F.lit("Unnamed: "), i.cast("string"))
    ).otherwise(C.clean_name_col(x)))


def detect_headers(grid: DataFrame, rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """H1-H3 per batch: ``batch_id, h1_row, h2_row, header_row, method, header``."""
    first = grid.where(F.col("row_idx") < rules.header_search_rows)
    is_h1 = header_hits(F.col("cells"), rules) >= rules.header_min_matches
    is_h2 = looks_like_header(F.col("cells"), rules)
    row = F.col("row_idx")
    agg = first.groupBy("batch_id").agg(
        F.min(F.when(is_h1, row)).alias("h1_row"),
        F.min_by(F.when(is_h1, F.col("cells")), F.when(is_h1, row)).alias("h1_cells"),
        F.min(F.when(is_h2, row)).alias("h2_row"),
        F.min_by(F.when(is_h2, F.col("cells")), F.when(is_h2, row)).alias("h2_cells"),
        F.min(row).alias("h3_row"),
        F.min_by(F.col("cells"), row).alias("h3_cells"),
    )
    method = (F.when(F.col("h1_row").isNotNull(), F.lit("match"))
              .when(F.col("h2_row").isNotNull(), F.lit("fallback")).otherwise(F.lit("first_row")))
    return agg.select(
        "batch_id", "h1_row", "h2_row",
        F.coalesce("h1_row", "h2_row", "h3_row").alias("header_row"),
        method.alias("method"),
        header_names(F.coalesce("h1_cells", "h2_cells", "h3_cells")).alias("header"),
    )


def positions(headers: DataFrame) -> DataFrame:
    """``batch_id, _header_row`` and the place (from 0, null where absent) of each expected column."""
    place = {c: F.array_position(F.col("header"), name) for name, c in R.HEADER_TO_COLUMN}
    return headers.select("batch_id", F.col("header_row").alias("_header_row"),
                          *[F.when(p > 0, (p - 1).cast("int")).alias(f"_at_{c}") for c, p in place.items()])


def promote_header(grid: DataFrame, rules: PayRules = DEFAULT_RULES,
                   headers: DataFrame | None = None, broadcast_bytes: int | None = None) -> DataFrame:
    """H4: rows below each batch's header, as the 24 canonical text columns.

    Columns whose header is absent are null (C8); unknown columns are left
    out (the output keeps only the expected ones, as P2 does).
    """
    h = positions(headers if headers is not None else detect_headers(grid, rules))
    rows = join_keyed(grid, h, "batch_id", broadcast_bytes=broadcast_bytes).where(F.col("row_idx") > F.col("_header_row"))
    return rows.select("batch_id", "row_idx", *[F.get("cells", F.col(f"_at_{c}")).alias(c) for c in R.INPUT_COLUMNS])


# -- columns of a sheet (H5, C2, C4, A5) ----------------------------------------------

WORD = 62           # positions in one number of the presence bitmap


def unique_names(names: Column) -> Column:
    """H5: a repeated header text gets ``.1``, ``.2``, ... in the order of the columns."""
    def named(x: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice(names, F.lit(1), i), lambda y: y == x))
        return F.when(before > 0, F.concat(x, F.lit("."), before.cast("string"))).otherwise(x)
    return F.transform(names, named)


def filled_positions(grid: DataFrame, headers: DataFrame, rules: PayRules = DEFAULT_RULES,
                     broadcast_bytes: int | None = None) -> DataFrame:
    """C2 measure: ``batch_id, filled``: the positions that hold a value below the header.

    Each row becomes one bitmap for each ``WORD`` of its positions; ``bit_or`` joins
    them on each task, so a batch of any size sends a few numbers a task.
    """
    first = headers.select("batch_id", F.col("header_row").alias("_header_row"))
    rows = join_keyed(grid, first, "batch_id", broadcast_bytes=broadcast_bytes).where(F.col("row_idx") > F.col("_header_row"))
    words = rows.select("batch_id", "cells", F.explode(F.sequence(F.lit(0), F.floor((F.size("cells") - 1) / WORD).cast("int"))).alias("word"))
    zero = F.lit(0).cast("bigint")
    part = F.slice("cells", F.col("word") * WORD + 1, F.lit(WORD))
    bits = F.transform(part, lambda x, i: F.when(text.is_empty_cell(x, rules.null_tokens), zero)
                       .otherwise(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)))
    found = words.groupBy("batch_id", "word").agg(F.bit_or(F.aggregate(bits, zero, lambda a, b: a.bitwiseOR(b))).alias("bits"))
    places = F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)),
                      lambda i: F.call_function("shiftright", F.col("bits"), i).bitwiseAND(F.lit(1).cast("bigint")) == 1)
    placed = found.select("batch_id", F.transform(places, lambda i: i + F.col("word") * WORD).alias("places"))
    return placed.groupBy("batch_id").agg(F.array_sort(F.flatten(F.collect_list("places"))).alias("filled"))


def sheet_columns(grid: DataFrame, rules: PayRules = DEFAULT_RULES, headers: DataFrame | None = None) -> DataFrame:
    """The columns each sheet keeps: ``batch_id, header, columns array<(position, name)>``.

    Columns without a name (C4) go, and columns without any value unless they are
    expected (C2).
    """
    h = stored(headers if headers is not None else detect_headers(grid, rules), "headers")
    named = h.select("batch_id", "header_row", unique_names(F.col("header")).alias("header"))
    filled = named.join(filled_positions(grid, h, rules), "batch_id", "left")
    every = F.transform("header", lambda x, i: F.struct(i.alias("position"), x.alias("name")))
    empty = F.array().cast("array<int>")
    return filled.select("batch_id", "header_row", "header", F.filter(every, lambda c: ~c["name"].startswith("Unnamed") & (
        F.array_contains(F.coalesce("filled", empty), c["position"]) | c["name"].isin(*rules.expected_headers))).alias("columns"))


def promote_all(grid: DataFrame, rules: PayRules = DEFAULT_RULES, broadcast_bytes: int | None = None) -> DataFrame:
    """H4 with what is not expected: ``promote_header`` and ``unknown``, a map from the
    name of each further column that the sheet keeps to the row's cell."""
    kept = sheet_columns(grid, rules)
    others = F.filter("columns", lambda c: ~c["name"].isin(*rules.expected_headers))
    h = positions(kept).join(kept.select("batch_id", others.alias("_others")), "batch_id")
    rows = join_keyed(grid, h, "batch_id", broadcast_bytes=broadcast_bytes).where(F.col("row_idx") > F.col("_header_row"))
    cells = F.transform("_others", lambda c: F.struct(c["name"], F.get("cells", c["position"])))
    return rows.select("batch_id", "row_idx", *[F.get("cells", F.col(f"_at_{c}")).alias(c) for c in R.INPUT_COLUMNS],
                       F.map_from_entries(cells).alias("unknown"))


def named_rows(grid: DataFrame, rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """K9: detected, promoted and cleaned rows (no derivation)."""
    return C.clean(compiled_apart(promote_header(grid, rules)), rules)
