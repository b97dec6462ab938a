"""The derived payment columns as native Column expressions.

Every rule is a ``when`` chain tested in the order the business states it.
Rates come from columns on the row (``tasa_*``, joined per batch by
``operators.rates.attach_rates``), so one plan serves any number of batches.
The area (D7) is computed by ``operators.areas``; ``derive_all`` wires the
whole chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import money, text
from ..rules import DEFAULT_RULES, PayRules
from ..session import compiled_apart


def ensure_inputs(df: DataFrame) -> DataFrame:
    """Add any missing input column as a null text column."""
    missing = {c: F.lit(None).cast("string") for c in R.INPUT_COLUMNS if c not in df.columns}
    return df.withColumns(missing) if missing else df


# -- coerced inputs ---------------------------------------------------------

def currency(df: DataFrame) -> Column:
    """Upper-cased, stripped ``moneda`` (null stays null)."""
    return text.upper_cell(text.as_text(F.col("moneda"), text.dtype_of(df, "moneda")))


def priority(df: DataFrame) -> Column:
    return text.int_col(df, "prioridad")


def amount(df: DataFrame, name: str) -> Column:
    return text.num_col(df, name)


# -- D1-D6 --------------------------------------------------------------------

def payment_currency(m: Column, p: Column, rules: PayRules = DEFAULT_RULES) -> Column:
    """D1 ``Moneda Pago``."""
    return (
        F.when(m.isNull(), F.lit("VES"))
        .when(m == "EUR", F.lit("EUR"))
        .when(m == "COP", F.lit("COP"))
        .when((m == "USD") & p.isin(*rules.usd_pay_priorities), F.lit("USD"))
        .otherwise(F.lit("VES"))
    )


def bank_account(m: Column, p: Column, account_text: Column,
                 rules: PayRules = DEFAULT_RULES) -> Column:
    """D2 ``Cuenta Bancaria``: USD outside the list pays to the default account."""
    return (
        F.when((m == "USD") & ~p.isin(*rules.usd_keep_account_priorities),
               F.lit(rules.default_usd_account))
        .otherwise(F.coalesce(account_text, F.lit("")))
    )


def payment_day(pay_currency: Column) -> Column:
    """D3 ``Dia de Pago``."""
    return F.when(text.upper_cell(pay_currency).isin("USD", "EUR"), F.lit(R.FRIDAY)) \
        .otherwise(F.lit(R.THURSDAY))


def final_amount(m: Column, p: Column, monto: Column, day: Column,
                 ves: Column, ves_thursday: Column, rules: PayRules = DEFAULT_RULES) -> Column:
    """D4 ``Monto Final``: VES and listed priorities are paid as is."""
    d = F.coalesce(text.upper_cell(day), F.lit(R.THURSDAY))
    return (
        F.when(monto == 0, F.lit(0.0))
        .when(m == "VES", monto)
        .when(p.isin(*rules.no_conversion_priorities), monto)
        .when(d == R.THURSDAY, monto * ves_thursday)
        .otherwise(monto * ves)
    )


def capex_final(ext: Column, ord_: Column, cadm: Column, mf: Column) -> Column:
    """D5 ``Monto Capex Final``: capex share of the final amount."""
    total = ext + ord_ + cadm
    return (
        F.when((ext == 0) & (ord_ == 0), F.lit(0.0))
        .when(total == 0, F.lit(0.0))
        .otherwise(((ext + ord_) / total) * mf)
    )


def opex_final(ext: Column, ord_: Column, cadm: Column, mf: Column) -> Column:
    """D6 ``Monto Opex Final``: opex share of the final amount."""
    total = ext + ord_ + cadm
    return (
        F.when((ext == 0) & (ord_ == 0), mf)
        .when(total == 0, mf)
        .otherwise((cadm / total) * mf)
    )


# -- D8-D16 -------------------------------------------------------------------

def capex_kind(area: Column, mcf: Column, mof: Column) -> Column:
    """D8 ``Tipo Capex 2``."""
    return (
        F.when(text.upper_cell(area) == R.RECARGAS, F.lit(R.RECARGAS))
        .when((mcf != 0) & (mof != 0), F.lit("MIXTA"))
        .when(mcf != 0, F.lit("CAPEX"))
        .otherwise(F.lit("OPEX"))
    )


def capex_type(area: Column, kind: Column, ext: Column, ord_: Column) -> Column:
    """D9 ``Tipo Capex``."""
    return (
        F.when(text.upper_cell(area) == R.RECARGAS, F.lit(R.RECARGAS))
        .when(text.upper_cell(kind) == "OPEX", F.lit("OPEX"))
        .when((ext != 0) & (ord_ != 0), F.lit("MIXTA"))
        .when(ext != 0, F.lit("EXT"))
        .otherwise(F.lit("ORD"))
    )


_NO_CAPEX_TYPES = ("OPEX", R.RECARGAS, "PRESTAMO")


def capex_share(ctype: Column, mcf: Column, ext: Column, ord_: Column, side: str) -> Column:
    """D10 (side='ORD') / D11 (side='EXT'): the capex amount of one side."""
    t = text.upper_cell(ctype)
    other = "EXT" if side == "ORD" else "ORD"
    mine = ord_ if side == "ORD" else ext
    total = ord_ + ext
    return (
        F.when(t.isin(*_NO_CAPEX_TYPES), F.lit(0.0))
        .when(t == other, F.lit(0.0))
        .when(t == side, mcf)
        .when(total == 0, F.lit(0.0))
        .otherwise(mcf * (mine / total))
    )


USD_PASSTHROUGH = {
    "monto_capex_ord_usd": ("USD",),
    "monto_capex_ext_usd": ("USD", "COP"),
    "monto_capex_usd": ("USD", "COP"),
    "monto_opex_usd": ("USD",),
}
USD_SOURCE = {
    "monto_capex_ord_usd": "monto_capex_ord_2",
    "monto_capex_ext_usd": "monto_capex_ext_3",
    "monto_capex_usd": "monto_capex_final",
    "monto_opex_usd": "monto_opex_final",
}


def usd_amount(df: DataFrame, target: str) -> Column:
    """D12-D15 over the row's derived columns and rates (``_pay`` and ``_day``, where it
    carries them, are the payment currency and day in upper case)."""
    pay, day = (F.col(h) if h in df.columns else text.upper_strip(F.col(c)) for h, c in (("_pay", "moneda_pago"), ("_day", "dia_pago")))
    return money.to_usd(
        F.col(USD_SOURCE[target]),
        pay, day,
        F.col("tasa_bolivares"), F.col("tasa_bolivares_jueves"), F.col("tasa_euro"),
        passthrough=USD_PASSTHROUGH[target],
    )


# -- wiring -------------------------------------------------------------------

HELPERS = ("_m", "_p", "_acct", "_mto", "_ext", "_ord", "_cadm", "_pay", "_day")


def derive_payment(df: DataFrame, rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """D1-D6. Needs the input columns and ``tasa_bolivares*`` rate columns.

    Coerced inputs are computed once into helper columns (``_m``, ``_p``,
    ...) that later stages read by name: each is used several times, so
    the optimizer keeps them as columns instead of copying the coercion
    into every rule (small generated code, one evaluation per row).
    ``derive_capex`` drops them.
    """
    df = ensure_inputs(df)
    df = df.withColumns({
        "_m": currency(df),
        "_p": priority(df),
        "_acct": text.as_text(F.col("cuenta"), text.dtype_of(df, "cuenta")),
        "_mto": amount(df, "monto"),
        "_ext": amount(df, "monto_capex_ext"),
        "_ord": amount(df, "monto_capex_ord"),
        "_cadm": amount(df, "monto_cadm"),
    })
    m, p = F.col("_m"), F.col("_p")
    ext, ord_, cadm = F.col("_ext"), F.col("_ord"), F.col("_cadm")
    df = df.withColumns({
        "moneda_pago": payment_currency(m, p, rules),
        "cuenta_bancaria": bank_account(m, p, F.col("_acct"), rules),
    })
    df = df.withColumn("dia_pago", payment_day(F.col("moneda_pago")))
    df = df.withColumn("monto_final", final_amount(
        m, p, F.col("_mto"), F.col("dia_pago"),
        F.col("tasa_bolivares"), F.col("tasa_bolivares_jueves"), rules))
    return df.withColumns({
        "monto_capex_final": capex_final(ext, ord_, cadm, F.col("monto_final")),
        "monto_opex_final": opex_final(ext, ord_, cadm, F.col("monto_final")),
    })


def derive_capex(df: DataFrame) -> DataFrame:
    """D8-D16. Needs D1-D7, the rate columns and ``derive_payment``'s helpers. The kinds and
    shares and the amounts in USD are compiled apart."""
    if "_ext" not in df.columns:
        df = df.withColumns({"_ext": amount(df, "monto_capex_ext"), "_ord": amount(df, "monto_capex_ord")})
    ext, ord_ = F.col("_ext"), F.col("_ord")
    mcf, mof = F.col("monto_capex_final"), F.col("monto_opex_final")
    df = df.withColumn("tipo_capex_2", capex_kind(F.col("area"), mcf, mof))
    df = df.withColumn("tipo_capex", capex_type(F.col("area"), F.col("tipo_capex_2"), ext, ord_))
    df = df.withColumns({
        "monto_capex_ord_2": capex_share(F.col("tipo_capex"), mcf, ext, ord_, "ORD"),
        "monto_capex_ext_3": capex_share(F.col("tipo_capex"), mcf, ext, ord_, "EXT"),
    })
    df = compiled_apart(df)
    df = df.withColumns({"_pay": text.upper_cell("moneda_pago"), "_day": text.upper_cell("dia_pago")})
    df = df.withColumns({t: usd_amount(df, t) for t in USD_PASSTHROUGH})
    df = df.withColumn("monto_total_usd", F.col("monto_capex_usd") + F.col("monto_opex_usd"))
    return df.drop(*[h for h in HELPERS if h in df.columns])
