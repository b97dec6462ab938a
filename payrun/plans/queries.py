"""The registered queries: one per operator group of the blueprint.

Each query takes ``(spark, sf_dir)``, reads the driver's tables through the
fixture views (``payrun.sources.fixtures``) and returns a DataFrame. Every
computed column has a fixed alias that the DuckDB oracle
(``payrun.oracle.oracle_queries``) uses too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import text
from ..operators import areas as A
from ..operators import clean as C
from ..operators import derive as D
from ..operators import header as H
from ..operators import publish as P
from ..operators import rates as RT
from ..operators import summary as S
from ..session import scratch_path, stored
from ..sinks import files as SF
from ..sinks import warehouse as WH
from ..sources import fixtures as FX
from ..sources import listing as LS
from ..sources import sheets as SH
from . import pipeline

# Fixed run time used by every compared query (P9): results must repeat.
RUN_TS = "2026-01-15 14:30:00"
ID = ["batch_id", "numero_factura", "numero_oc"]


def run_ts():
    return F.lit(RUN_TS).cast("timestamp_ntz")


# -- shared inputs -------------------------------------------------------------

def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return C.clean(D.ensure_inputs(FX.invoices(spark, sf)))


def batch_rates(spark: SparkSession, sf: str) -> DataFrame:
    return RT.snapshot_from_quote_rows(FX.quotes(spark, sf), ["batch_id"])


def day_rates(spark: SparkSession, sf: str) -> DataFrame:
    return RT.snapshot_from_quote_rows(FX.quotes(spark, sf), ["snap"])


def derived(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline.step1(FX.invoices(spark, sf), FX.areas(spark, sf), batch_rates(spark, sf))


def ves_quotes(spark: SparkSession, sf: str) -> DataFrame:
    q = FX.quotes(spark, sf).where(F.col("pair") == "VES")
    return q.select("snap", "pos", F.from_json("payload", RT.QUOTE_MAP).alias("quote"))


# -- cleaning (C1-C10, A7) -------------------------------------------------------

def q_drop_summary_rows(spark, sf):
    return cleaned(spark, sf).drop(*[c for c in R.INPUT_COLUMNS if c not in FX_COLUMNS])


FX_COLUMNS = FX.INVOICE_COLUMNS


def q_drop_empty_rows(spark, sf):
    inv = C.null_tokens(FX.raw_invoices(spark, sf))
    return C.drop_empty_rows(inv).groupBy("batch_id").agg(F.count("*").alias("rows_kept"))


def q_empty_columns(spark, sf):
    return C.empty_columns(C.clean(FX.raw_invoices(spark, sf)))


def q_null_tokens(spark, sf):
    inv = C.null_tokens(FX.raw_invoices(spark, sf))
    text_cols = [f.name for f in inv.schema.fields if f.name != "batch_id" and f.dataType.simpleString() == "string"]
    return inv.groupBy("batch_id").agg(*[F.count(c).alias(f"nn_{c}") for c in text_cols])


def q_coerce_numbers(spark, sf):
    df = C.coerce_numbers(cleaned(spark, sf))
    return df.select(*ID, *R.AMOUNT_COLUMNS)


def q_coerce_priority(spark, sf):
    df = cleaned(spark, sf)
    return df.select(*ID, F.col("prioridad").alias("prioridad_text"),
                     text.int_col(df, "prioridad").alias("prioridad"))


def q_clean_names(spark, sf):
    h = H.detect_headers(FX.grid(spark, sf))
    return h.select("batch_id", F.posexplode("header").alias("position", "name")) \
            .where(~F.col("name").startswith("Unnamed"))


def q_removed_rows(spark, sf):
    return C.removed_rows(FX.raw_invoices(spark, sf))


def q_coerce_text_amounts(spark, sf):
    """C6 and C10 on amounts that come as text."""
    df = C.clean(FX.raw_invoices(spark, sf))
    return C.coerce_numbers(df).select(*ID, *R.AMOUNT_COLUMNS, *[F.col(c).isNull().alias(f"{c}_empty") for c in ("tienda", "rif")])


# -- header (H1-H5) -----------------------------------------------------------

def q_header_match(spark, sf):
    g = FX.grid(spark, sf).where(F.col("row_idx") < R.HEADER_SEARCH_ROWS)
    hits = H.header_hits(F.col("cells"))
    return (g.where(hits >= R.HEADER_MIN_MATCHES)
            .groupBy("batch_id").agg(F.min("row_idx").alias("h1_row"),
                                     F.min_by(hits, F.col("row_idx")).alias("hits")))


def q_header_fallback(spark, sf):
    h = H.detect_headers(FX.grid(spark, sf))
    return h.select("batch_id", "h2_row", "header_row", "method")


def q_promote_header(spark, sf):
    return H.promote_header(FX.grid(spark, sf))


def q_named_rows(spark, sf):
    """K9: the cleaned table of each sheet, without derivation."""
    return H.named_rows(FX.grid(spark, sf))


def q_kept_columns(spark, sf):
    """The columns of each sheet that cleaning keeps."""
    return H.sheet_columns(FX.grid(spark, sf)).select("batch_id", F.inline("columns"))


def q_sheet_summary(spark, sf):
    """Number and names of the processed columns."""
    return S.sheet_summary(FX.grid(spark, sf)).select("batch_id", "total_columnas", F.array_join("columnas", "|").alias("columnas"))


def q_unknown_cells(spark, sf):
    """The cells of columns that no header list names."""
    rows = H.promote_all(FX.grid(spark, sf)).select("batch_id", "row_idx", F.explode("unknown").alias("name", "cell"))
    return rows.groupBy("batch_id", "name").agg(F.count("*").alias("rows"), F.count("cell").alias("filled"), F.max("cell").alias("largest"))


# -- derivation (D1-D16) -----------------------------------------------------------

DERIVED_VIEWS = {
    "payment_currency": ["moneda", "prioridad", "moneda_pago"],
    "bank_account": ["moneda", "cuenta", "cuenta_bancaria"],
    "payment_day": ["moneda_pago", "dia_pago"],
    "final_amount": ["monto", "monto_final"],
    "capex_final": ["monto_capex_final"],
    "opex_final": ["monto_opex_final"],
    "area": ["proveedor", "sucursal", "solicitante", "area"],
    "capex_kind": ["area", "tipo_capex_2"],
    "capex_type": ["tipo_capex_2", "tipo_capex"],
    "capex_ord_share": ["tipo_capex", "monto_capex_ord_2"],
    "capex_ext_share": ["tipo_capex", "monto_capex_ext_3"],
    "capex_ord_usd": ["monto_capex_ord_usd"],
    "capex_ext_usd": ["monto_capex_ext_usd"],
    "capex_usd": ["monto_capex_usd"],
    "opex_usd": ["monto_opex_usd"],
    "total_usd": ["monto_capex_usd", "monto_opex_usd", "monto_total_usd"],
}


def _derived_view(cols):
    def q(spark, sf):
        return derived(spark, sf).select(*ID, *cols)
    return q


# -- lookup (J1-J5) ---------------------------------------------------------------

def q_area_lookup(spark, sf):
    df = A.attach_area_lookup(cleaned(spark, sf), FX.areas(spark, sf))
    return df.select(*ID, F.col("_sol_key").alias("requester"), F.col(A.LOOKUP_COL).alias("lookup_area"))


def q_provider_rule(spark, sf):
    g = cleaned(spark, sf).groupBy("proveedor").agg(F.count("*").alias("rows"))
    prov = F.coalesce(text.upper_strip(F.col("proveedor")), F.lit(""))
    return g.select("proveedor", A.provider_rule(prov).alias("always_recargas"), "rows")


def q_provider_branch_rule(spark, sf):
    g = cleaned(spark, sf).groupBy("proveedor", "sucursal").agg(F.count("*").alias("rows"))
    prov = F.coalesce(text.upper_strip(F.col("proveedor")), F.lit(""))
    suc = F.coalesce(text.upper_strip(F.col("sucursal")), F.lit(""))
    return g.select("proveedor", "sucursal", A.provider_branch_rule(prov, suc).alias("branch_recargas"), "rows")


def q_many_rules(spark, sf):
    """J2, J3 with rules that are tables: the gram index."""
    always, branch = FX.many_rules(spark, sf)
    df = A.flag_rules(A.add_area_inputs(cleaned(spark, sf)), always, branch)
    return (df.groupBy("proveedor", "sucursal", F.col("_always").alias("always_recargas"), F.col("_branch").alias("branch_recargas"))
            .agg(F.count("*").alias("rows")))


def q_apply_rates(spark, sf):
    df = RT.attach_rates(cleaned(spark, sf), batch_rates(spark, sf))
    return df.groupBy("batch_id", *R.RATE_COLUMNS).agg(F.count("*").alias("rows"))


def q_priority_membership(spark, sf):
    df = cleaned(spark, sf)
    g = df.groupBy("prioridad").agg(F.count("*").alias("rows"))
    p = text.int_col(g, "prioridad")
    return g.select(
        F.col("prioridad").alias("prioridad_text"), p.alias("prioridad"),
        p.isin(*R.USD_PAY_PRIORITIES).alias("usd_pay"),
        p.isin(*R.USD_KEEP_ACCOUNT_PRIORITIES).alias("usd_keep_account"),
        p.isin(*R.NO_CONVERSION_PRIORITIES).alias("no_conversion"),
        "rows")


# -- rates (S4-S7, R1-R7, A10) -----------------------------------------------------

def q_pick_quote(spark, sf):
    picked = RT.pick_quote(ves_quotes(spark, sf), ["snap"])
    return picked.select("snap", "pos", F.col("quote")["nombre"].alias("nombre"))


def q_parse_quote(spark, sf):
    q = ves_quotes(spark, sf)
    return q.select("snap", "pos", RT.quote_class(F.col("quote")["nombre"]).alias("quote_class"),
                    RT.ves_value(F.col("quote")).alias("value"))


def q_default_rate(spark, sf):
    return day_rates(spark, sf).select("snap", "ves", "eur", "cop", "ves_source", "ves_date",
                                       "ves_is_default", "eur_is_default", "cop_is_default")


def q_thursday_rate(spark, sf):
    return day_rates(spark, sf).select("snap", "ves", "ves_thursday")


def q_eur_from_json(spark, sf):
    q = FX.quotes(spark, sf).where(F.col("pair") == "EUR")
    return q.select("snap", "pos", RT.eur_value(F.col("payload")).alias("eur"))


def q_cop_object_or_list(spark, sf):
    q = FX.quotes(spark, sf).where(F.col("pair") == "COP")
    return q.select("snap", "pos", RT.cop_value(F.col("payload")).alias("cop"))


def q_rates_collected(spark, sf):
    return RT.rates_collected(FX.quotes(spark, sf), ["snap"])


def q_answer_quotes(spark, sf):
    """Each quote of each VES answer."""
    q = RT.explode_quote_list(FX.answers(spark, sf).where(F.col("pair") == "VES").withColumnRenamed("pos", "answer"), ["snap", "answer"])
    return q.select("snap", "answer", "pos", F.col("quote")["nombre"].alias("nombre"),
                    RT.quote_class(F.col("quote")["nombre"]).alias("quote_class"), RT.ves_value(F.col("quote")).alias("value"))


def q_answer_rates(spark, sf):
    """S4-S7, R1-R7 over answers that hold lists of quotes."""
    r = RT.snapshot_from_quote_rows(FX.answers(spark, sf), ["snap"])
    return r.select("snap", *[F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss").alias(c) if c.endswith("fetched_at") else c for c in RT.RATE_FIELDS])


def q_answers_collected(spark, sf):
    return RT.rates_collected(FX.answers(spark, sf), ["snap"])


# -- summary (A1-A6, K10) ------------------------------------------------------------

def q_rows_per_batch(spark, sf):
    return S.rows_per_batch(derived(spark, sf))


def q_rows_by_currency(spark, sf):
    return S.rows_by(derived(spark, sf), "moneda_pago")


def q_rows_by_day(spark, sf):
    return S.rows_by(derived(spark, sf), "dia_pago")


def q_amount_sums(spark, sf):
    return S.amount_sums(cleaned(spark, sf))


def q_exact_sums(spark, sf):
    """A4 exact: sums in units of 2**-80."""
    return S.exact_amount_sums(cleaned(spark, sf), unit_bits=80)


def q_batch_summary(spark, sf):
    return S.batch_summary(derived(spark, sf))


# -- publishing (P1-P12, K1, K2, K5, K7, K8) -------------------------------------------

def q_renamed_output(spark, sf):
    return P.display_names(derived(spark, sf))


def q_ordered_output(spark, sf):
    return P.processed_sheet(derived(spark, sf))


def q_warehouse_shape(spark, sf):
    return P.warehouse_shape(derived(spark, sf), run_ts())


def q_json_records(spark, sf):
    return P.json_records(P.processed_sheet(derived(spark, sf)))


def q_rates_report(spark, sf):
    return P.rates_report(batch_rates(spark, sf))


def q_dated_runs(spark, sf):
    batches = cleaned(spark, sf).groupBy("batch_id").agg(F.count("*").alias("rows"))
    return P.dated_runs(batches, run_ts(), keep=("rows",))


# -- sinks (K1, K3-K6, K8, A11) and step 2 on what they wrote (C9, S10) -----------------

def staged(spark, sf) -> DataFrame:
    """Step 1's processed sheet, written to staging and read again."""
    path = scratch_path(spark, "staging")
    SF.write_staging(P.processed_sheet(derived(spark, sf)), path, few=SF.few_batches(batch_rates(spark, sf)))
    return SH.read_staging(spark, path)


def q_staged_sheet(spark, sf):
    return staged(spark, sf)


def q_restaged_batches(spark, sf):
    """K6: all batches are staged, then one of them again with fewer rows."""
    path, few = scratch_path(spark, "staging"), SF.few_batches(batch_rates(spark, sf))
    SF.write_staging(P.processed_sheet(derived(spark, sf)), path, few=few)
    fewer = SH.read_staging(spark, path).where((F.col("batch_id") == "batch-1") & (F.col("`Tipo factura`") == "A"))
    SF.write_staging(stored(fewer, "fewer"), path, few=few)       # stored: its own folder is replaced
    return SH.read_staging(spark, path).groupBy("batch_id", F.col("`Tipo factura`").alias("tipo_factura")).agg(F.count("*").alias("rows"))


def q_step2_shape(spark, sf):
    """Step 2 on step 1's own output, up to the warehouse shape."""
    return pipeline.step2_shape(staged(spark, sf), FX.areas(spark, sf), batch_rates(spark, sf), run_ts())


def warehouse_name(spark) -> str:
    return "payrun_" + scratch_path(spark, "").rstrip("/").rsplit("-", 1)[1]


def q_warehouse_load(spark, sf):
    """K4: the table's rows after a load."""
    name = warehouse_name(spark)
    WH.load(P.warehouse_shape(derived(spark, sf), run_ts()), name, "empty")
    return spark.table(name)


def q_load_report(spark, sf):
    """What each mode reports, one after the other on one table."""
    rows, name = stored(P.warehouse_shape(derived(spark, sf), run_ts()), "shape"), warehouse_name(spark)
    report = None
    for step, (mode, load) in enumerate([("empty", "l1"), ("append", "l2"), ("append", "l2"), ("append", "l3"), ("replace", "l4")]):
        one = WH.load(rows, name, mode, load).select(F.lit(step).alias("step"), "load_id", "mode", "rows_uploaded", "rows_in_table")
        report = one if report is None else report.unionByName(one)
    return report


def run_root(spark, sf) -> str:
    """A run written to the dated output (K5, K3, K8)."""
    root = scratch_path(spark, "logs")
    SF.write_run(P.processed_sheet(derived(spark, sf)), batch_rates(spark, sf), FX.areas(spark, sf), root, run_ts())
    return root


def q_run_output(spark, sf):
    """K5, K3, K8: rows of each part of a run by its folders."""
    root = run_root(spark, sf)
    parts = [SF.read_folders(spark, f"{root}/{part}").groupBy("run_date", "run_stamp", *(["batch_id"] if part == "detail" else []))
             .agg(F.count("*").alias("rows")).withColumn("part", F.lit(part)) for part in ("detail", "rates", "areas")]
    return parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)


# -- listing (S8, A8, A9, O1) -------------------------------------------------------

def q_files_by_date(spark, sf):
    """A8, O1 over the files that a run wrote."""
    return LS.files_by_date(LS.list_files(spark, run_root(spark, sf) + "/detail"))


def q_listing_totals(spark, sf):
    """A9, S8, F6 over the files that a run wrote: the folders they lie in are known
    from the rows, how many files a folder has is Spark's choice."""
    files = LS.list_files(spark, run_root(spark, sf) + "/detail")
    totals = LS.listing_totals(files)
    folders = files.agg(F.count_distinct(F.regexp_extract("path", "(.*)/", 1)).alias("total_carpetas"),
                        F.count_if(F.col("bytes") == 0).alias("archivos_vacios"))
    return totals.crossJoin(folders).select("total_fechas", "total_carpetas", "archivos_vacios",
                                            (F.col("total_archivos") >= F.col("total_carpetas")).alias("en_cada_carpeta"))


# -- flagship (blueprint 7.2) -------------------------------------------------------

def q_payment_totals(spark, sf):
    """Cleaned invoices -> rates -> D1, D3, D4 -> totals per batch, currency, day."""
    df = RT.attach_rates(cleaned(spark, sf), batch_rates(spark, sf))
    df = D.derive_payment(df)
    return (df.groupBy("batch_id", "moneda_pago", "dia_pago")
            .agg(F.count("*").alias("rows"), S.money_sum(F.col("monto_final")).alias("total_monto_final")))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    reg = {
        "payment_totals": q_payment_totals,
        "drop_summary_rows": q_drop_summary_rows,
        "drop_empty_rows": q_drop_empty_rows,
        "empty_columns": q_empty_columns,
        "coerce_numbers": q_coerce_numbers,
        "coerce_priority": q_coerce_priority,
        "coerce_text_amounts": q_coerce_text_amounts,
        "null_tokens": q_null_tokens,
        "clean_names": q_clean_names,
        "removed_rows": q_removed_rows,
        "header_match": q_header_match,
        "header_fallback": q_header_fallback,
        "promote_header": q_promote_header,
        "named_rows": q_named_rows,
        "kept_columns": q_kept_columns,
        "sheet_summary": q_sheet_summary,
        "unknown_cells": q_unknown_cells,
    }
    reg.update({name: _derived_view(cols) for name, cols in DERIVED_VIEWS.items()})
    reg.update({
        "area_lookup": q_area_lookup,
        "provider_rule": q_provider_rule,
        "provider_branch_rule": q_provider_branch_rule,
        "many_rules": q_many_rules,
        "apply_rates": q_apply_rates,
        "priority_membership": q_priority_membership,
        "pick_quote": q_pick_quote,
        "parse_quote": q_parse_quote,
        "default_rate": q_default_rate,
        "thursday_rate": q_thursday_rate,
        "eur_from_json": q_eur_from_json,
        "cop_object_or_list": q_cop_object_or_list,
        "rates_collected": q_rates_collected,
        "answer_quotes": q_answer_quotes,
        "answer_rates": q_answer_rates,
        "answers_collected": q_answers_collected,
        "rows_per_batch": q_rows_per_batch,
        "rows_by_currency": q_rows_by_currency,
        "rows_by_day": q_rows_by_day,
        "amount_sums": q_amount_sums,
        "exact_sums": q_exact_sums,
        "batch_summary": q_batch_summary,
        "renamed_output": q_renamed_output,
        "ordered_output": q_ordered_output,
        "warehouse_shape": q_warehouse_shape,
        "json_records": q_json_records,
        "rates_report": q_rates_report,
        "dated_runs": q_dated_runs,
        "staged_sheet": q_staged_sheet,
        "restaged_batches": q_restaged_batches,
        "step2_shape": q_step2_shape,
        "warehouse_load": q_warehouse_load,
        "load_report": q_load_report,
        "run_output": q_run_output,
        "files_by_date": q_files_by_date,
        "listing_totals": q_listing_totals,
    })
    return reg
