"""Exchange-rate snapshots from landed quote payloads.

A quote service answer is stored as JSON text. For each snapshot key (a
batch, a day) one VES quote is picked (official, else parallel, else the
first; the last one wins inside a class), COP and EUR values are read from
their payloads, and a failed, zero or unreadable value falls back to the
default rate. All of it is one partial aggregate per key plus a projection.

The resulting ``rates`` table has one row per key and is joined to the
invoices on that key (J4): measured, then broadcast, or salted where it is too large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules as R
from ..functions import text
from ..rules import DEFAULT_RULES, PayRules
from .keyed import join_keyed

QUOTE_MAP = "map<string,string>"
QUOTE_LIST = "array<map<string,string>>"

PAIRS = ("ves", "cop", "eur")
RATE_FIELDS = ("ves", "ves_thursday", "eur", "cop", *(f"{p}_{f}" for f in ("source", "date", "fetched_at", "is_default", "answered")
                                                     for p in PAIRS))


# -- S4: VES quote lists -------------------------------------------------------

def quote_list(payload: Column) -> Column:
    """The quotes of an answer: a JSON list, or one landed quote object.

    Null where the answer is broken, holds something else than objects, or a quote
    whose name is null: reading such an answer fails as a whole in the source.
    """
    quotes = F.coalesce(F.from_json(payload, QUOTE_LIST), F.array(F.from_json(payload, QUOTE_MAP)))
    sound = F.forall(quotes, lambda q: q.isNotNull() & ~(F.map_contains_key(q, "nombre") & q["nombre"].isNull()))
    return F.when(sound, quotes)


def best_in_answer(quotes: Column, pos: Column) -> Column:
    """R1 + R2 inside one answer, a fold over its list: the order of the best quote
    among all answers of a key, and that quote.

    ``c`` is the class (official first); among official or parallel quotes the last one
    of the last answer is best, among others the first one of the first answer.
    """
    def order(q: Column, i: Column) -> Column:
        cls = quote_class(q["nombre"])
        turn = F.when(cls == 2, F.lit(-1)).otherwise(F.lit(1))
        return F.struct((-cls).alias("c"), (turn * pos).alias("p"), (turn * i).alias("i"))

    none = F.lit(None).cast("struct<c:int,p:bigint,i:int>")
    orders = F.transform(quotes, order)
    best = F.aggregate(orders, none, lambda kept, o: F.when(kept.isNull() | (o > kept), o.cast("struct<c:int,p:bigint,i:int>")).otherwise(kept))
    found = F.transform(F.array(best), lambda o: F.struct(o.alias("order"), F.get(quotes, F.abs(o["i"])).alias("quote")))
    return F.get(F.filter(found, lambda f: F.size(F.map_keys(f["quote"])) > 0), F.lit(0))


def explode_quote_list(df: DataFrame, keys: list[str], payload: str = "payload") -> DataFrame:
    """One row per quote of an answer: ``keys..., pos, quote``.

    A broken answer yields no quotes (default rate later).
    """
    return df.select(*keys, F.posexplode(quote_list(F.col(payload))).alias("pos", "quote"))


def quote_class(name: Column) -> Column:
    """0 = official (``bcv``/``oficial``), 1 = parallel, 2 = other."""
    n = F.lower(F.coalesce(name, F.lit("")))
    return (F.when(n.contains("bcv") | n.contains("oficial"), F.lit(0))
            .when(n.contains("paralelo"), F.lit(1))
            .otherwise(F.lit(2)))


def pick_order(cls: Column, pos: Column) -> Column:
    """R2 ordering key for ``max_by``: best class first; last of an official
    or parallel class; first of the rest."""
    return F.struct((-cls).alias("c"), F.when(cls == 2, -pos).otherwise(pos).alias("p"))


def pick_quote(quotes: DataFrame, keys: list[str]) -> DataFrame:
    """R1+R2: the quote used for each key: ``keys..., pos, quote``.

    A partial aggregate: each task keeps one best quote per key before the
    shuffle, so a key with very many quotes costs one row per task.
    """
    cls = quote_class(F.col("quote")["nombre"])
    best = F.max_by(F.struct("pos", "quote"), pick_order(cls, F.col("pos")))
    return quotes.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.pos", "b.quote")


def keyed_value(q: Column, chain: tuple[str, ...]) -> Column:
    """The value of the first key of ``chain`` present in the quote.

    Presence, not non-null, decides: an explicit null stops the chain.
    No key present -> ``'0'``.
    """
    out = F.lit("0")
    for k in reversed(chain):
        out = F.when(F.map_contains_key(q, k), q[k]).otherwise(out)
    return out


def parse_comma_number(v: Column) -> Column:
    """R4 (VES): strip, comma -> point, parse; unreadable -> 0."""
    return F.coalesce(text.text_to_double(F.replace(text.strip(v), F.lit(","), F.lit("."))),
                      F.lit(0.0))


def ves_value(q: Column) -> Column:
    return parse_comma_number(keyed_value(q, ("promedio", "compra")))


# -- S5: COP (object or list) ---------------------------------------------------

def cop_quote(payload: Column) -> Column:
    """First element of a list answer, or the object itself."""
    return F.coalesce(F.get(F.from_json(payload, QUOTE_LIST), 0), F.from_json(payload, QUOTE_MAP))


def _plain_float_ok(q: Column, key: str) -> Column:
    """A key that is absent, or present with plain-float text."""
    return ~F.map_contains_key(q, key) | text.text_to_double(q[key]).isNotNull()


def cop_value_of_quote(q: Column) -> Column:
    """S5 value of a parsed COP quote: promedio, else compra, else valor.

    A present ``compra``/``venta`` that does not parse fails the quote, as
    does an empty answer; failure -> null (default later). ``q`` should be
    a column reference: it is read several times.
    """
    v = text.text_to_double(keyed_value(q, ("promedio", "compra", "valor")))
    ok = (F.size(F.map_keys(q)) > 0) & _plain_float_ok(q, "compra") & _plain_float_ok(q, "venta")
    return F.when(ok, v)


def cop_value(payload: Column) -> Column:
    """S5 value straight from a payload (single-column use)."""
    return cop_value_of_quote(cop_quote(payload))


def cop_source(q: Column) -> Column:
    """Who gave a parsed COP quote."""
    return (F.when(F.map_contains_key(q, "nombre"), q["nombre"])
            .when(F.map_contains_key(q, "fuente"), q["fuente"]).otherwise(F.lit(R.COP_SOURCE)))


# -- S6: EUR at rates.USD ------------------------------------------------------

def eur_value(payload: Column) -> Column:
    """``rates.USD`` of the answer; an unreadable ``amount`` fails it."""
    usd = text.text_to_double(F.get_json_object(payload, "$.rates.USD"))
    amount = F.get_json_object(payload, "$.amount")
    ok = amount.isNull() | text.text_to_double(amount).isNotNull()
    return F.when(ok, usd)


# -- R5/R6/R7: defaults, the Thursday rate, where a rate comes from -----------------------

def rates_from_quotes(df: DataFrame, keys: list[str], rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """R3-R7 over one row per key holding ``ves_quote`` (map), ``cop_payload`` and
    ``eur_payload`` (text) and ``*_fetched_at``; missing parts give defaults.

    A rate is answered where its answer could be read, and a default where it was not
    answered or reads as 0: source, date and time of an answered rate are kept even
    where its value is not used.

    Built in projections over named intermediate columns: a parsed value read several
    times stays one column instead of being copied into every expression that uses it
    (keeps plans small for the optimizer).
    """
    times = [f"{p}_fetched_at" for p in PAIRS]
    parsed = df.select(
        *keys, "ves_quote", *times,
        ves_value(F.col("ves_quote")).alias("_ves"),
        eur_value(F.col("eur_payload")).alias("_eur"),
        cop_quote(F.col("cop_payload")).alias("_cop_q"),
        F.get_json_object("eur_payload", "$.date").alias("_eur_date"),
    )
    valued = parsed.select("*", cop_value_of_quote(F.col("_cop_q")).alias("_cop"))
    flags = valued.select(
        "*", F.col("ves_quote").isNotNull().alias("ves_answered"), F.col("_cop").isNotNull().alias("cop_answered"),
        (F.coalesce("_eur", F.lit(0.0)) != 0).alias("eur_answered"),
        *[(F.coalesce(F.col(f"_{k}"), F.lit(0.0)) == 0).alias(f"{k}_is_default") for k in PAIRS],
    )
    defaults = {"ves": rules.default_ves_rate, "eur": rules.default_eur_rate, "cop": rules.default_cop_rate}
    rated = flags.select(
        "*", *[F.when(F.col(f"{k}_is_default"), F.lit(float(d))).otherwise(F.col(f"_{k}")).alias(k)
               for k, d in defaults.items()])
    q, c = F.col("ves_quote"), F.col("_cop_q")
    sources = {"ves": F.when(F.map_contains_key(q, "nombre"), q["nombre"]).otherwise(F.lit(R.VES_SOURCE)),
               "cop": cop_source(c), "eur": F.lit(R.EUR_SOURCE)}
    stated = {"ves": F.when(F.map_contains_key(q, "fechaActualizacion"), q["fechaActualizacion"]),
              "cop": F.when(F.map_contains_key(c, "fechaActualizacion"), c["fechaActualizacion"]), "eur": F.col("_eur_date")}
    return rated.select(
        *keys, "ves",
        (F.col("ves") + F.lit(float(rules.thursday_margin))).alias("ves_thursday"),
        "eur", "cop",
        *[F.when(F.col(f"{k}_answered"), sources[k]).otherwise(F.lit("default")).alias(f"{k}_source") for k in PAIRS],
        *[F.when(F.col(f"{k}_answered"), F.coalesce(stated[k], F.date_format(f"{k}_fetched_at", "yyyy-MM-dd"))).alias(f"{k}_date")
          for k in PAIRS],
        *times, *[f"{k}_is_default" for k in PAIRS], *[f"{k}_answered" for k in PAIRS],
    )


def snapshot_from_quote_rows(quotes: DataFrame, keys: list[str],
                             rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """S7 in one pass: ``quotes(keys..., pos, pair, payload[, fetched_at])`` -> rates.

    Each row is one fetched answer: a VES row holds a list of quotes or one landed
    quote, COP and EUR rows a whole answer. Per key: the R2 pick among the quotes of all
    VES answers, and the latest COP and EUR answers. Lists are folded inside their row
    and one partial aggregate follows (no row per quote is made), then R3-R7.
    """
    if "fetched_at" not in quotes.columns:
        quotes = quotes.withColumn("fetched_at", F.lit(None).cast("timestamp"))
    is_ves, is_cop, is_eur = (F.col("pair") == p for p in ("VES", "COP", "EUR"))
    read = quotes.select(*keys, "pos", "pair", "payload", "fetched_at",
                         F.when(is_ves, best_in_answer(quote_list(F.col("payload")), F.col("pos").cast("long"))).alias("_best"))
    best, order = F.col("_best"), F.col("_best")["order"]

    def latest(value: str, rows: Column) -> Column:
        return F.max_by(F.when(rows, F.col(value)), F.when(rows, F.col("pos")))

    agg = read.groupBy(*keys).agg(
        F.max_by(best["quote"], order).alias("ves_quote"),
        latest("payload", is_cop).alias("cop_payload"),
        latest("payload", is_eur).alias("eur_payload"),
        F.coalesce(F.max_by(F.when(best.isNotNull(), F.col("fetched_at")), order), latest("fetched_at", is_ves)).alias("ves_fetched_at"),
        latest("fetched_at", is_cop).alias("cop_fetched_at"),
        latest("fetched_at", is_eur).alias("eur_fetched_at"),
    )
    return rates_from_quotes(agg, keys, rules)


def rates_collected(quotes: DataFrame, keys: list[str]) -> DataFrame:
    """How many of the three rates were answered per key, used or not."""
    r = snapshot_from_quote_rows(quotes, keys)
    return r.select(*keys, sum((F.col(f"{k}_answered").cast("int") for k in PAIRS), F.lit(0)).alias("rates_ok"))


def default_rates(df_keys: DataFrame, rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """The all-default snapshot for each key (no quote landed)."""
    return df_keys.select("*",
                          F.lit(float(rules.default_ves_rate)).alias("ves"),
                          F.lit(float(rules.default_ves_thursday_rate)).alias("ves_thursday"),
                          F.lit(float(rules.default_eur_rate)).alias("eur"),
                          F.lit(float(rules.default_cop_rate)).alias("cop"))


# -- J4: rates on every row ----------------------------------------------------

def attach_rates(df: DataFrame, rates: DataFrame, key: str = "batch_id",
                 rules: PayRules = DEFAULT_RULES, broadcast_bytes: int | None = None) -> DataFrame:
    """Join the snapshot on ``key``; a batch without one uses defaults.

    The facts are not moved by the key, whatever the number of batches (``join_keyed``).
    """
    r = rates.select(
        F.col(key),
        F.col("ves").alias("_ves"), F.col("ves_thursday").alias("_ves5"),
        F.col("eur").alias("_eur"), F.col("cop").alias("_cop"),
    )
    return join_keyed(df, r, key, "left", broadcast_bytes).withColumns({
        "tasa_bolivares": F.coalesce("_ves", F.lit(float(rules.default_ves_rate))),
        "tasa_bolivares_jueves": F.coalesce("_ves5", F.lit(float(rules.default_ves_thursday_rate))),
        "tasa_euro": F.coalesce("_eur", F.lit(float(rules.default_eur_rate))),
        "tasa_cop": F.coalesce("_cop", F.lit(float(rules.default_cop_rate))),
    }).drop("_ves", "_ves5", "_eur", "_cop")


def literal_rates(df: DataFrame, ves: float, eur: float, cop: float,
                  rules: PayRules = DEFAULT_RULES) -> DataFrame:
    """Single-snapshot form: the same rates as literals on every row."""
    return df.withColumns({
        "tasa_bolivares": F.lit(float(ves)),
        "tasa_bolivares_jueves": F.lit(float(ves) + rules.thursday_margin),
        "tasa_euro": F.lit(float(eur)),
        "tasa_cop": F.lit(float(cop)),
    })
