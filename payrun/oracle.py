"""DuckDB SQL for every registered query: the independent oracle.

The Spark side is written with DataFrame expressions (``payrun.operators``);
this module states the same rules a second time as plain SQL over the
driver's tables, so the two can be compared value for value. Helpers below
return SQL text fragments; ``base_ctes`` builds the shared CTE chain.
"""

from __future__ import annotations

from . import rules as R
from .functions.text import NUMBER_PATTERN, WHITESPACE
from .sources import fixtures as FX

WS = WHITESPACE.replace("'", "''")

# Empty-cell texts, stated here apart from the package's own list.
EMPTY_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(vals) -> str:
    return "(" + ", ".join(lit(v) if isinstance(v, str) else str(v) for v in vals) + ")"


def strip(x: str) -> str:
    return f"trim({x}, '{WS}')"


def upper_strip(x: str) -> str:
    return f"upper({strip(x)})"


def num_text(x: str) -> str:
    """Number text -> double, else NULL (matches ``text_to_double``)."""
    s = strip(x)
    return f"(CASE WHEN regexp_matches({s}, '{NUMBER_PATTERN}') THEN TRY_CAST({s} AS DOUBLE) END)"


def num_double(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR isnan({x}) OR isinf({x}) THEN 0.0E0 ELSE {x} END)"


def num_of_text(x: str) -> str:
    v = num_text(x)
    return f"coalesce({v}, 0.0E0)"


def int_of_text(x: str) -> str:
    return f"coalesce(TRY_CAST(trunc({num_of_text(x)}) AS BIGINT), 0)"


def null_token(x: str) -> str:
    return f"(CASE WHEN {x} IN {in_list(EMPTY_TEXTS)} THEN NULL ELSE {x} END)"


# Invoice columns of the fixture and their kind.
TEXT_COLS = ("numero_factura", "numero_oc", "tipo_factura", "nombre_lote", "proveedor", "rif",
             "fecha_documento", "tienda", "sucursal", "moneda", "fecha_vencimiento", "cuenta",
             "prioridad", "solicitante")
DOUBLE_COLS = ("monto", "monto_capex_ext", "monto_capex_ord", "monto_cadm")
ABSENT_COLS = ("banco", "codigo_cuenta", "metodo_pago", "pago_independiente", "fecha_creacion",
               "proveedor_remito")


def summary_test(x: str) -> str:
    u = upper_strip(x)
    parts = [f"contains({u}, {lit(t)})" for t in R.SUMMARY_ROW_CONTAINS]
    return f"coalesce({' OR '.join(parts)} OR {u} = {lit(R.SUMMARY_ROW_EQUALS)}, false)"


def cleaned_cte() -> str:
    """C10 + C1 + C5 over ``inv`` (C8 adds the absent columns as NULL)."""
    cols = ["batch_id"] + [f"{null_token(c)} AS {c}" for c in TEXT_COLS] + list(DOUBLE_COLS)
    cols += [f"CAST(NULL AS VARCHAR) AS {c}" for c in ABSENT_COLS]
    data = list(TEXT_COLS) + list(DOUBLE_COLS)
    all_null = " AND ".join(f"{c} IS NULL" for c in data)
    return (f"tok AS (SELECT {', '.join(cols)} FROM inv),\n"
            f"cl AS (SELECT * FROM tok WHERE NOT ({all_null}) AND NOT {summary_test('numero_factura')})")


VES_SOURCE, COP_SOURCE, EUR_SOURCE = "DolarAPI Venezuela", "DolarAPI Colombia", "Frankfurter API (ECB)"


def list_quotes_cte(key: str, cls: str, p: str, src: str) -> str:
    """The quote that each list answer stands for -> ``{p}vq``; ``{p}lq`` has all quotes of sound answers."""
    return f"""
{p}el AS (SELECT {key}, pos, fetched_at, unnest(l) AS e, generate_subscripts(l, 1) - 1 AS i FROM (
        SELECT {key}, pos, fetched_at, json_extract(payload, '$[*]') AS l FROM {src}
        WHERE pair = 'VES' AND json_valid(payload) AND json_type(CASE WHEN json_valid(payload) THEN payload END) = 'ARRAY')),
{p}lq AS (SELECT {key}, pos, fetched_at, i, e::VARCHAR AS payload, json_extract_string(e, '$.nombre') AS nombre FROM (
        SELECT *, max(CASE WHEN json_type(e) <> 'OBJECT' OR json_type(e, '$.nombre') = 'NULL' THEN 1 ELSE 0 END) OVER (PARTITION BY {key}, pos) AS broken FROM {p}el)
        WHERE broken = 0),
{p}vq AS (SELECT {key}, pos, fetched_at, payload, nombre FROM (
        SELECT *, row_number() OVER (PARTITION BY {key}, pos ORDER BY {cls}, CASE WHEN {cls} = 2 THEN i ELSE -i END) AS k FROM {p}lq)
        WHERE k = 1 AND payload <> '{{}}'),"""


def rates_ctes(key: str, p: str = "", src: str = "quotes", lists: bool = False) -> str:
    """R1-R7 from ``src`` per ``key`` -> CTE ``{p}rates`` (CTE names prefixed)."""
    cls = ("(CASE WHEN contains(lower(coalesce(nombre, '')), 'bcv') OR contains(lower(coalesce(nombre, '')), 'oficial') "
           "THEN 0 WHEN contains(lower(coalesce(nombre, '')), 'paralelo') THEN 1 ELSE 2 END)")
    prom = "json_exists(payload, '$.promedio')"
    comp = "json_exists(payload, '$.compra')"
    vtxt = (f"(CASE WHEN {prom} THEN json_extract_string(payload, '$.promedio') "
            f"WHEN {comp} THEN json_extract_string(payload, '$.compra') ELSE '0' END)")
    ves_val = f"coalesce({num_text(f'replace({strip(vtxt)}, {lit(',')}, {lit('.')})')}, 0.0E0)"
    cq = "cq"
    cop_chain = (f"(CASE WHEN json_exists({cq}, '$.promedio') THEN json_extract_string({cq}, '$.promedio') "
                 f"WHEN json_exists({cq}, '$.compra') THEN json_extract_string({cq}, '$.compra') "
                 f"WHEN json_exists({cq}, '$.valor') THEN json_extract_string({cq}, '$.valor') ELSE '0' END)")

    def ok(k):
        v = num_text(f"json_extract_string({cq}, '$.{k}')")
        return f"(NOT json_exists({cq}, '$.{k}') OR {v} IS NOT NULL)"

    cop_val = (f"(CASE WHEN {cq} IS NOT NULL AND {cq} <> '{{}}' AND {ok('compra')} AND {ok('venta')} "
               f"THEN {num_text(cop_chain)} END)")
    eur_usd = num_text("json_extract_string(ep, '$.rates.USD')")
    eur_amount = "json_extract_string(ep, '$.amount')"
    eur_ok = f"({eur_amount} IS NULL OR {num_text(eur_amount)} IS NOT NULL)"
    eur_val = f"(CASE WHEN ep IS NOT NULL AND {eur_ok} THEN {eur_usd} END)"
    margin = float(R.THURSDAY_MARGIN)
    vq = list_quotes_cte(key, cls, p, src) if lists else f"""
{p}vq AS (SELECT {key}, pos, fetched_at, payload, json_extract_string(payload, '$.nombre') AS nombre
       FROM {src} WHERE pair = 'VES'),"""

    def source(k: str, v: str) -> str:
        return f"CASE WHEN {k}_answered THEN {v} ELSE 'default' END AS {k}_source"

    def date(k: str, v: str) -> str:
        return f"CASE WHEN {k}_answered THEN coalesce({v}, strftime({k}_at, '%Y-%m-%d')) END AS {k}_date"

    return vq + f"""
{p}vpick AS (SELECT {key}, pos, payload, nombre, fetched_at,
          row_number() OVER (PARTITION BY {key} ORDER BY {cls}, CASE WHEN {cls} = 2 THEN pos ELSE -pos END) AS rn
          FROM {p}vq),
{p}ves AS (SELECT {key}, {ves_val} AS v, coalesce(nombre, {lit(VES_SOURCE)}) AS nombre, fetched_at,
        json_extract_string(payload, '$.fechaActualizacion') AS fecha
        FROM {p}vpick WHERE rn = 1),
{p}copl AS (SELECT {key}, seen, CASE WHEN json_valid(p) THEN p END AS cp FROM (
          SELECT {key}, arg_max(payload, pos) AS p, arg_max(fetched_at, pos) AS seen FROM {src} WHERE pair = 'COP' GROUP BY {key})),
{p}cop AS (SELECT {key}, seen, {cop_val} AS v, json_extract_string(cq, '$.fechaActualizacion') AS fecha,
          coalesce(json_extract_string(cq, '$.nombre'), json_extract_string(cq, '$.fuente'), {lit(COP_SOURCE)}) AS nombre FROM (
          SELECT {key}, seen, CASE WHEN json_type(cp) = 'ARRAY' THEN json_extract(cp, '$[0]')::VARCHAR ELSE cp END AS cq
          FROM {p}copl)),
{p}eurl AS (SELECT {key}, seen, CASE WHEN json_valid(p) THEN p END AS ep FROM (
          SELECT {key}, arg_max(payload, pos) AS p, arg_max(fetched_at, pos) AS seen FROM {src} WHERE pair = 'EUR' GROUP BY {key})),
{p}eur AS (SELECT {key}, seen, {eur_val} AS v, json_extract_string(ep, '$.date') AS fecha FROM {p}eurl),
{p}keys AS (SELECT {key}, arg_max(fetched_at, pos) FILTER (WHERE pair = 'VES') AS seen FROM {src} GROUP BY {key}),
{p}joined AS (SELECT k.{key}, ves.v AS ves_v, cop.v AS cop_v, eur.v AS eur_v, ves.nombre AS ves_n, cop.nombre AS cop_n,
  ves.fecha AS ves_f, cop.fecha AS cop_f, eur.fecha AS eur_f, coalesce(ves.fetched_at, k.seen) AS ves_at, cop.seen AS cop_at, eur.seen AS eur_at,
  ves.nombre IS NOT NULL AS ves_answered, cop.v IS NOT NULL AS cop_answered, coalesce(eur.v, 0) <> 0 AS eur_answered
 FROM {p}keys k LEFT JOIN {p}ves ves USING ({key}) LEFT JOIN {p}cop cop USING ({key}) LEFT JOIN {p}eur eur USING ({key})),
{p}rates AS (
 SELECT {key},
  CASE WHEN coalesce(ves_v, 0) = 0 THEN {R.DEFAULT_VES_RATE:.2f}E0 ELSE ves_v END AS ves,
  CASE WHEN coalesce(ves_v, 0) = 0 THEN {R.DEFAULT_VES_RATE:.2f}E0 ELSE ves_v END + {margin}E0 AS ves_thursday,
  CASE WHEN coalesce(eur_v, 0) = 0 THEN {R.DEFAULT_EUR_RATE:.2f}E0 ELSE eur_v END AS eur,
  CASE WHEN coalesce(cop_v, 0) = 0 THEN {R.DEFAULT_COP_RATE!r}E0 ELSE cop_v END AS cop,
  {source('ves', 'ves_n')}, {source('cop', 'cop_n')}, {source('eur', lit(EUR_SOURCE))},
  {date('ves', 'ves_f')}, {date('cop', 'cop_f')}, {date('eur', 'eur_f')}, ves_at, cop_at, eur_at,
  ves_answered, cop_answered, eur_answered,
  coalesce(ves_v, 0) = 0 AS ves_is_default,
  coalesce(eur_v, 0) = 0 AS eur_is_default,
  coalesce(cop_v, 0) = 0 AS cop_is_default
 FROM {p}joined)"""


def lookup_cte() -> str:
    return (f"lk AS (SELECT {strip('CAST(codigo AS VARCHAR)')} AS codigo, "
            f"arg_max(coalesce({strip('CAST(area AS VARCHAR)')}, 'SERVICIOS'), pos) AS lk_area "
            f"FROM areas WHERE codigo IS NOT NULL GROUP BY 1)")


def contains_either(v: str, rule: str) -> str:
    r = lit(rule.upper())
    return f"(contains({v}, {r}) OR contains({r}, {v}))"


def provider_rule(prov: str) -> str:
    return "(" + " OR ".join(contains_either(prov, r) for r in R.ALWAYS_RECARGAS_PROVIDERS) + ")"


def branch_rule(prov: str, suc: str) -> str:
    parts = []
    for p, branches in R.BRANCH_RECARGAS_PROVIDERS:
        b = " OR ".join(contains_either(suc, x) for x in branches)
        parts.append(f"({contains_either(prov, p)} AND ({b}))")
    return "(" + " OR ".join(parts) + ")"


def to_usd(x: str, passthrough) -> str:
    return (f"(CASE WHEN {x} = 0 THEN 0.0E0 WHEN mp IN {in_list(passthrough)} THEN {x} "
            f"WHEN mp = 'EUR' THEN {x} * eur WHEN dp = 'MARTES' THEN (CASE WHEN ves <> 0 THEN {x} / ves ELSE 0.0E0 END) "
            f"ELSE (CASE WHEN ves5 <> 0 THEN {x} / ves5 ELSE 0.0E0 END) END)")


def derive_ctes() -> str:
    """D1-D16 over ``jr`` (cleaned rows with ves/ves5/eur/cop) -> ``dv``."""
    L1, L2, L3 = (in_list(x) for x in (R.USD_PAY_PRIORITIES, R.USD_KEEP_ACCOUNT_PRIORITIES,
                                       R.NO_CONVERSION_PRIORITIES))
    return f"""
c0 AS (SELECT *, {upper_strip('moneda')} AS m, {int_of_text('prioridad')} AS p,
        {num_double('monto')} AS mto, {num_double('monto_capex_ext')} AS ext,
        {num_double('monto_capex_ord')} AS ord, {num_double('monto_cadm')} AS cadm FROM jr),
c1 AS (SELECT *,
 CASE WHEN m IS NULL THEN 'VES' WHEN m = 'EUR' THEN 'EUR' WHEN m = 'COP' THEN 'COP'
      WHEN m = 'USD' AND p IN {L1} THEN 'USD' ELSE 'VES' END AS moneda_pago,
 CASE WHEN m = 'USD' AND p NOT IN {L2} THEN {lit(R.DEFAULT_USD_ACCOUNT)} ELSE coalesce(cuenta, '') END AS cuenta_bancaria
 FROM c0),
c2 AS (SELECT *, CASE WHEN moneda_pago IN ('USD', 'EUR') THEN 'VIERNES' ELSE 'JUEVES' END AS dia_pago FROM c1),
c3 AS (SELECT *,
 CASE WHEN mto = 0 THEN 0.0E0 WHEN m = 'VES' THEN mto WHEN p IN {L3} THEN mto
      WHEN dia_pago = 'JUEVES' THEN mto * ves5 ELSE mto * ves END AS monto_final FROM c2),
c4 AS (SELECT *,
 CASE WHEN ext = 0 AND ord = 0 THEN 0.0E0 WHEN ext + ord + cadm = 0 THEN 0.0E0
      ELSE ((ext + ord) / (ext + ord + cadm)) * monto_final END AS monto_capex_final,
 CASE WHEN ext = 0 AND ord = 0 THEN monto_final WHEN ext + ord + cadm = 0 THEN monto_final
      ELSE (cadm / (ext + ord + cadm)) * monto_final END AS monto_opex_final FROM c3),
c5 AS (SELECT c4.*, lk.lk_area,
 coalesce({upper_strip('proveedor')}, '') AS prov_u, coalesce({upper_strip('sucursal')}, '') AS suc_u,
 coalesce({strip('solicitante')}, '0') AS sol_k
 FROM c4 LEFT JOIN lk ON coalesce({strip('c4.solicitante')}, '0') = lk.codigo),
c6 AS (SELECT *,
 CASE WHEN {provider_rule('prov_u')} THEN 'RECARGAS' WHEN {branch_rule('prov_u', 'suc_u')} THEN 'RECARGAS'
      WHEN sol_k = '' OR coalesce({num_text('sol_k')}, 1.0E0) = 0 THEN 'SERVICIOS'
      ELSE coalesce(lk_area, 'SERVICIOS') END AS area FROM c5),
c7 AS (SELECT *,
 CASE WHEN {upper_strip('area')} = 'RECARGAS' THEN 'RECARGAS'
      WHEN monto_capex_final <> 0 AND monto_opex_final <> 0 THEN 'MIXTA'
      WHEN monto_capex_final <> 0 THEN 'CAPEX' ELSE 'OPEX' END AS tipo_capex_2 FROM c6),
c8 AS (SELECT *,
 CASE WHEN {upper_strip('area')} = 'RECARGAS' THEN 'RECARGAS' WHEN tipo_capex_2 = 'OPEX' THEN 'OPEX'
      WHEN ext <> 0 AND ord <> 0 THEN 'MIXTA' WHEN ext <> 0 THEN 'EXT' ELSE 'ORD' END AS tipo_capex FROM c7),
c9 AS (SELECT *,
 CASE WHEN tipo_capex IN ('OPEX', 'RECARGAS', 'PRESTAMO') THEN 0.0E0 WHEN tipo_capex = 'EXT' THEN 0.0E0
      WHEN tipo_capex = 'ORD' THEN monto_capex_final WHEN ord + ext = 0 THEN 0.0E0
      ELSE monto_capex_final * (ord / (ord + ext)) END AS monto_capex_ord_2,
 CASE WHEN tipo_capex IN ('OPEX', 'RECARGAS', 'PRESTAMO') THEN 0.0E0 WHEN tipo_capex = 'ORD' THEN 0.0E0
      WHEN tipo_capex = 'EXT' THEN monto_capex_final WHEN ord + ext = 0 THEN 0.0E0
      ELSE monto_capex_final * (ext / (ord + ext)) END AS monto_capex_ext_3,
 moneda_pago AS mp, dia_pago AS dp FROM c8),
dv AS (SELECT *,
 {to_usd('monto_capex_ord_2', ('USD',))} AS monto_capex_ord_usd,
 {to_usd('monto_capex_ext_3', ('USD', 'COP'))} AS monto_capex_ext_usd,
 {to_usd('monto_capex_final', ('USD', 'COP'))} AS monto_capex_usd,
 {to_usd('monto_opex_final', ('USD',))} AS monto_opex_usd,
 {to_usd('monto_capex_final', ('USD', 'COP'))} + {to_usd('monto_opex_final', ('USD',))} AS monto_total_usd
 FROM c9)"""


def base_ctes(with_rates: bool = True, with_derive: bool = True) -> str:
    """inv, areas, quotes, cleaned rows and (optionally) rates + D1-D16."""
    refs = FX.duck_refs()
    parts = [f"inv AS ({FX.invoices_sql(refs)})", f"areas AS ({FX.areas_sql(refs)})",
             f"quotes AS ({FX.quotes_sql(refs)})", cleaned_cte()]
    if with_rates or with_derive:
        parts.append(rates_ctes("batch_id").strip())
        parts.append("jr AS (SELECT cl.*, coalesce(r.ves, 36.5E0) AS ves, coalesce(r.ves_thursday, 41.5E0) AS ves5, "
                     "coalesce(r.eur, 1.1E0) AS eur, coalesce(r.cop, 0.00024E0) AS cop "
                     "FROM cl LEFT JOIN rates r USING (batch_id))")
    if with_derive:
        parts.append(lookup_cte())
        parts.append(derive_ctes().strip())
    return "WITH " + ",\n".join(parts) + "\n"


# -- header detection over the grid -----------------------------------------------

def header_ctes() -> str:
    """H1-H3 over the grid fixture -> ``hd(batch_id, h1_row, h2_row, header_row, method, header)``."""
    exp = in_list(R.EXPECTED_HEADERS)
    nonblank = f"x IS NOT NULL AND {strip('x')} <> ''"
    names = (f"list_transform(cells, lambda x, i: CASE WHEN x IS NULL OR {strip('x')} = '' "
             f"THEN 'Unnamed: ' || CAST(i - 1 AS VARCHAR) "
             f"ELSE replace(replace({strip('x')}, chr(10), ' '), chr(13), '') END)")
    return f"""g AS ({FX.grid_sql(FX.duck_refs(), 'list_value')}),
sc AS (SELECT batch_id, row_idx,
  CAST(len(list_filter(cells, lambda x: {strip('x')} IN {exp})) AS INTEGER) AS hits,
  len(list_filter(cells, lambda x: {nonblank})) AS nb,
  len(list_filter(cells, lambda x: {nonblank} AND {num_text('x')} IS NULL)) AS nt
  FROM g WHERE row_idx < {R.HEADER_SEARCH_ROWS}),
hr AS (SELECT batch_id,
  min(CASE WHEN hits >= {R.HEADER_MIN_MATCHES} THEN row_idx END) AS h1_row,
  min(CASE WHEN nb >= {R.FALLBACK_MIN_CELLS} AND nt >= nb * {R.FALLBACK_TEXT_SHARE} THEN row_idx END) AS h2_row,
  min(row_idx) AS h3_row FROM sc GROUP BY batch_id),
hd AS (SELECT hr.batch_id, h1_row, h2_row, coalesce(h1_row, h2_row, h3_row) AS header_row,
  CASE WHEN h1_row IS NOT NULL THEN 'match' WHEN h2_row IS NOT NULL THEN 'fallback' ELSE 'first_row' END AS method,
  {names} AS header
  FROM hr JOIN g ON g.batch_id = hr.batch_id AND g.row_idx = coalesce(h1_row, h2_row, h3_row))
"""


# -- the registered queries ------------------------------------------------------------

FX_COLS = FX.INVOICE_COLUMNS
ID = "batch_id, numero_factura, numero_oc"

DERIVED_VIEWS = {
    "payment_currency": "moneda, prioridad, moneda_pago",
    "bank_account": "moneda, cuenta, cuenta_bancaria",
    "payment_day": "moneda_pago, dia_pago",
    "final_amount": "monto, monto_final",
    "capex_final": "monto_capex_final",
    "opex_final": "monto_opex_final",
    "area": "proveedor, sucursal, solicitante, area",
    "capex_kind": "area, tipo_capex_2",
    "capex_type": "tipo_capex_2, tipo_capex",
    "capex_ord_share": "tipo_capex, monto_capex_ord_2",
    "capex_ext_share": "tipo_capex, monto_capex_ext_3",
    "capex_ord_usd": "monto_capex_ord_usd",
    "capex_ext_usd": "monto_capex_ext_usd",
    "capex_usd": "monto_capex_usd",
    "opex_usd": "monto_opex_usd",
    "total_usd": "monto_capex_usd, monto_opex_usd, monto_total_usd",
}

# 24 sheet columns and 16 derived ones.
DERIVED_WIDTH = 40
RUN_TS = "2026-01-15 14:30:00"


def _money_sum(x: str) -> str:
    return f"coalesce(sum(CAST({x} AS DECIMAL(28,8))), CAST(0 AS DECIMAL(38,8)))"


def _display_select() -> list[str]:
    """Derived canonical columns (Spark's order) under their display names."""
    from .operators.publish import CANONICAL_TO_DISPLAY
    inputs = ["batch_id"] + [c for c in FX_COLS] + list(ABSENT_COLS)
    out = []
    for c in inputs:
        out.append(f'{c} AS "{CANONICAL_TO_DISPLAY[c]}"' if c in CANONICAL_TO_DISPLAY else c)
    out += ["ves AS tasa_bolivares", "ves5 AS tasa_bolivares_jueves", "eur AS tasa_euro", "cop AS tasa_cop"]
    out += [f'{c} AS "{CANONICAL_TO_DISPLAY[c]}"' for c in R.DERIVED_COLUMNS]
    return out


def _warehouse_select() -> list[str]:
    from .operators.publish import DATE_FIELDS, FLOAT_FIELDS, INT_FIELDS
    disp = dict(R.DISPLAY_TO_COLUMN)
    fmts = {"yyyy-MM-dd": "%Y-%m-%d", "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S", "dd/MM/yyyy": "%d/%m/%Y",
            "yyyy/MM/dd": "%Y/%m/%d", "dd-MM-yyyy": "%d-%m-%Y"}
    out = ["batch_id"]
    for d, w in R.WAREHOUSE_NAMES:
        c = disp[d]
        if w in FLOAT_FIELDS:
            out.append(f"CAST({num_double(c)} AS DOUBLE) AS {w}")
        elif w in DATE_FIELDS:
            tries = ", ".join(f"CAST(try_strptime({strip(c)}, '{fmts[f]}') AS DATE)" for f in R.DATE_FORMATS)
            out.append(f"CAST(coalesce({tries}) AS DATE) AS {w}")
        elif w in INT_FIELDS:
            out.append(f"CAST({int_of_text(c)} AS BIGINT) AS {w}")
        else:
            s = f"coalesce(CAST({c} AS VARCHAR), '')"
            out.append(f"CASE WHEN {s} IN ('nan', 'None') THEN '' ELSE {s} END AS {w}")
    out += ["ves AS tasa_bolivares", "ves5 AS tasa_bolivares_jueves", "eur AS tasa_euro", "cop AS tasa_cop",
            f"TIMESTAMP '{RUN_TS}' AS timestamp"]
    return out


def oracle_queries() -> dict[str, str]:
    full = base_ctes()
    plain = base_ctes(with_rates=False, with_derive=False)
    days = "WITH " + ",\n".join([f"quotes AS ({FX.quotes_sql(FX.duck_refs())})", rates_ctes("snap", "d_").strip()]) + "\n"
    hdr = "WITH " + header_ctes()
    q: dict[str, str] = {}

    q["payment_totals"] = full + ("SELECT batch_id, moneda_pago, dia_pago, count(*) AS rows, "
                                  f"{_money_sum('monto_final')} AS total_monto_final FROM dv GROUP BY ALL")
    # cleaning
    q["drop_summary_rows"] = plain + f"SELECT batch_id, {', '.join(FX_COLS)} FROM cl"
    all_null = " AND ".join(f"{c} IS NULL" for c in FX_COLS)
    raw = (f"WITH raw AS ({FX.raw_invoices_sql(FX.duck_refs())}),\n"
           f"rtok AS (SELECT batch_id, {', '.join(f'{null_token(c)} AS {c}' for c in FX_COLS)} FROM raw),\n"
           f"rcl AS (SELECT * FROM rtok WHERE NOT ({all_null}) AND NOT {summary_test('numero_factura')})\n")
    q["drop_empty_rows"] = raw + f"SELECT batch_id, count(*) AS rows_kept FROM rtok WHERE NOT ({all_null}) GROUP BY batch_id"
    q["empty_columns"] = raw + f"SELECT batch_id, {', '.join(f'count({c}) AS {c}' for c in FX_COLS)} FROM rcl GROUP BY batch_id"
    q["null_tokens"] = raw + f"SELECT batch_id, {', '.join(f'count({c}) AS nn_{c}' for c in FX_COLS)} FROM rtok GROUP BY batch_id"
    q["coerce_text_amounts"] = raw + (f"SELECT {ID}, {', '.join(f'{num_of_text(c)} AS {c}' for c in DOUBLE_COLS)}, "
                                      "tienda IS NULL AS tienda_empty, rif IS NULL AS rif_empty FROM rcl")
    q["coerce_numbers"] = plain + f"SELECT {ID}, {', '.join(f'{num_double(c)} AS {c}' for c in DOUBLE_COLS)} FROM cl"
    q["coerce_priority"] = plain + f"SELECT {ID}, prioridad AS prioridad_text, {int_of_text('prioridad')} AS prioridad FROM cl"
    q["clean_names"] = hdr + ("SELECT batch_id, position, name FROM (SELECT batch_id, "
                              "CAST(generate_subscripts(header, 1) - 1 AS INTEGER) AS position, unnest(header) AS name FROM hd) "
                              "WHERE NOT starts_with(name, 'Unnamed')")
    q["removed_rows"] = raw + (f"SELECT batch_id, count(*) AS rows_in, count(*) FILTER (WHERE {all_null}) AS empty_rows, "
                               f"count(*) FILTER (WHERE NOT ({all_null}) AND {summary_test('numero_factura')}) AS summary_rows "
                               "FROM rtok GROUP BY batch_id")
    # header
    q["header_match"] = hdr + ("SELECT batch_id, min(row_idx) AS h1_row, arg_min(hits, row_idx) AS hits FROM sc "
                               f"WHERE hits >= {R.HEADER_MIN_MATCHES} GROUP BY batch_id")
    q["header_fallback"] = hdr + "SELECT batch_id, h2_row, header_row, method FROM hd"
    picks = ", ".join(
        f"CASE WHEN list_position(header, {lit(name)}) IS NOT NULL THEN cells[list_position(header, {lit(name)})] END AS {c}"
        for name, c in R.HEADER_TO_COLUMN)
    q["promote_header"] = hdr + (f"SELECT g.batch_id, g.row_idx, {picks} FROM g JOIN hd ON g.batch_id = hd.batch_id "
                                 "WHERE g.row_idx > hd.header_row")
    named = [c for _, c in R.HEADER_TO_COLUMN]
    none = " AND ".join(f"{c} IS NULL" for c in named)
    q["named_rows"] = hdr + (f", pm AS (SELECT g.batch_id, g.row_idx, {picks} FROM g JOIN hd ON g.batch_id = hd.batch_id WHERE g.row_idx > hd.header_row), "
                             f"pt AS (SELECT batch_id, row_idx, {', '.join(f'{null_token(c)} AS {c}' for c in named)} FROM pm) "
                             f"SELECT * FROM pt WHERE NOT ({none}) AND NOT {summary_test('numero_factura')}")
    exp = in_list(R.EXPECTED_HEADERS)
    kept = hdr + f""", un AS (SELECT batch_id, header_row, position, name || CASE WHEN k > 1 THEN '.' || (k - 1) ELSE '' END AS name FROM (
          SELECT *, row_number() OVER (PARTITION BY batch_id, name ORDER BY position) AS k FROM (SELECT batch_id, header_row,
            CAST(generate_subscripts(header, 1) - 1 AS INTEGER) AS position, unnest(header) AS name FROM hd))),
        cell AS (SELECT g.batch_id, row_idx, CAST(generate_subscripts(cells, 1) - 1 AS INTEGER) AS position, unnest(cells) AS cell
                 FROM g JOIN hd ON g.batch_id = hd.batch_id AND g.row_idx > hd.header_row),
        fill AS (SELECT batch_id, position, count(*) FILTER (WHERE {null_token('cell')} IS NOT NULL) AS filled FROM cell GROUP BY ALL),
        kc AS (SELECT batch_id, position, name FROM un LEFT JOIN fill USING (batch_id, position)
               WHERE NOT starts_with(name, 'Unnamed') AND (coalesce(filled, 0) > 0 OR name IN {exp}))"""
    q["kept_columns"] = kept + "SELECT * FROM kc"
    added = "Moneda Pago|Cuenta Bancaria|Dia de Pago|Monto Final|Monto Capex Final|Monto Opex Final|AREA|Tipo Capex 2|Tipo Capex|" \
            "Monto Capex ORD 2|Monto Capex EXT 3|Monto Capex ORD USD|Monto Capex EXT USD|Monto CAPEX USD|Monto OPEX USD|Monto Total USD"
    q["sheet_summary"] = kept + (f"SELECT batch_id, CAST(count(*) + 16 AS INTEGER) AS total_columnas, "
                                 f"string_agg(name, '|' ORDER BY position) || '|' || {lit(added)} AS columnas FROM kc GROUP BY batch_id")
    q["unknown_cells"] = kept + (f"SELECT batch_id, name, count(*) AS rows, count(cell) AS filled, max(cell) AS largest "
                                 f"FROM kc JOIN cell USING (batch_id, position) WHERE name NOT IN {exp} GROUP BY ALL")
    # derivation
    for name, cols in DERIVED_VIEWS.items():
        q[name] = full + f"SELECT {ID}, {cols} FROM dv"
    # lookup
    q["area_lookup"] = full + f"SELECT {ID}, sol_k AS requester, lk_area AS lookup_area FROM c5"
    prov = f"coalesce({upper_strip('proveedor')}, '')"
    suc = f"coalesce({upper_strip('sucursal')}, '')"
    q["provider_rule"] = plain + (f"SELECT proveedor, {provider_rule(prov)} AS always_recargas, count(*) AS rows "
                                  "FROM cl GROUP BY proveedor")
    q["provider_branch_rule"] = plain + (f"SELECT proveedor, sucursal, {branch_rule(prov, suc)} AS branch_recargas, "
                                         "count(*) AS rows FROM cl GROUP BY proveedor, sucursal")
    either = "(contains({0}, {1}) OR contains({1}, {0}))".format
    q["many_rules"] = plain + f""", a AS ({FX.MANY_ALWAYS_SQL.format(**FX.duck_refs())}), b AS ({FX.MANY_BRANCH_SQL.format(**FX.duck_refs())}),
        pr AS (SELECT proveedor, sucursal, {prov} AS p, {suc} AS s, count(*) AS rows FROM cl GROUP BY proveedor, sucursal)
        SELECT proveedor, sucursal, rows, EXISTS (SELECT 1 FROM a WHERE {either('p', 'rule')}) AS always_recargas,
          EXISTS (SELECT 1 FROM b WHERE {either('p', 'provider')} AND {either('s', 'branch')}) AS branch_recargas FROM pr"""
    q["apply_rates"] = full + ("SELECT batch_id, ves AS tasa_bolivares, ves5 AS tasa_bolivares_jueves, eur AS tasa_euro, "
                               "cop AS tasa_cop, count(*) AS rows FROM jr GROUP BY ALL")
    pint = int_of_text("prioridad")
    L1, L2, L3 = (in_list(x) for x in (R.USD_PAY_PRIORITIES, R.USD_KEEP_ACCOUNT_PRIORITIES, R.NO_CONVERSION_PRIORITIES))
    q["priority_membership"] = plain + (f"SELECT prioridad AS prioridad_text, {pint} AS prioridad, {pint} IN {L1} AS usd_pay, "
                                        f"{pint} IN {L2} AS usd_keep_account, {pint} IN {L3} AS no_conversion, count(*) AS rows "
                                        "FROM cl GROUP BY prioridad")
    # rates
    q["pick_quote"] = days + "SELECT snap, pos, nombre FROM d_vpick WHERE rn = 1"
    cls = ("CASE WHEN contains(lower(coalesce(nombre, '')), 'bcv') OR contains(lower(coalesce(nombre, '')), 'oficial') "
           "THEN 0 WHEN contains(lower(coalesce(nombre, '')), 'paralelo') THEN 1 ELSE 2 END")
    vtxt = ("(CASE WHEN json_exists(payload, '$.promedio') THEN json_extract_string(payload, '$.promedio') "
            "WHEN json_exists(payload, '$.compra') THEN json_extract_string(payload, '$.compra') ELSE '0' END)")
    vval = f"coalesce({num_text(f'replace({strip(vtxt)}, {lit(',')}, {lit('.')})')}, 0.0E0)"
    q["parse_quote"] = days + f"SELECT snap, pos, {cls} AS quote_class, {vval} AS value FROM d_vq"
    q["default_rate"] = days + ("SELECT snap, ves, eur, cop, ves_source, ves_date, ves_is_default, eur_is_default, "
                                "cop_is_default FROM d_rates")
    q["thursday_rate"] = days + "SELECT snap, ves, ves_thursday FROM d_rates"
    # single-answer values: the same expressions as the snapshot, per row
    eur_usd = num_text("json_extract_string(ep, '$.rates.USD')")
    eur_amount = "json_extract_string(ep, '$.amount')"
    eur_val = f"(CASE WHEN ep IS NOT NULL AND ({eur_amount} IS NULL OR {num_text(eur_amount)} IS NOT NULL) THEN {eur_usd} END)"
    q["eur_from_json"] = days + (f"SELECT snap, pos, {eur_val} AS eur FROM (SELECT snap, pos, "
                                 "CASE WHEN json_valid(payload) THEN payload END AS ep FROM quotes WHERE pair = 'EUR')")
    cop_body = rates_ctes("snap", "x_")
    start = cop_body.index("x_cop AS (SELECT snap, seen, ") + len("x_cop AS (SELECT snap, seen, ")
    cop_val = cop_body[start:cop_body.index(" AS v, json_extract_string(cq", start)]
    q["cop_object_or_list"] = days + (f"SELECT snap, pos, {cop_val} AS cop FROM (SELECT snap, pos, "
                                      "CASE WHEN json_type(cp) = 'ARRAY' THEN json_extract(cp, '$[0]')::VARCHAR ELSE cp END AS cq "
                                      "FROM (SELECT snap, pos, CASE WHEN json_valid(payload) THEN payload END AS cp "
                                      "FROM quotes WHERE pair = 'COP'))")
    collected = "SELECT snap, CAST(ves_answered AS INTEGER) + CAST(cop_answered AS INTEGER) + CAST(eur_answered AS INTEGER) AS rates_ok FROM "
    q["rates_collected"] = days + collected + "d_rates"
    answers = "WITH " + ",\n".join([f"answers AS ({FX.answers_sql(FX.duck_refs())})",
                                    rates_ctes("snap", "a_", "answers", lists=True).strip()]) + "\n"
    q["answers_collected"] = answers + collected + "a_rates"
    times = ", ".join(f"strftime({k}_at, '%Y-%m-%dT%H:%M:%S') AS {k}_fetched_at" for k in ("ves", "cop", "eur"))
    q["answer_rates"] = answers + f"SELECT * EXCLUDE (ves_at, cop_at, eur_at), {times} FROM a_rates"
    q["answer_quotes"] = answers + (f"SELECT snap, pos AS answer, i::INTEGER AS pos, nombre, {cls} AS quote_class, {vval} AS value FROM a_lq")
    # summary
    q["rows_per_batch"] = full + "SELECT batch_id, count(*) AS rows FROM dv GROUP BY batch_id"
    q["rows_by_currency"] = full + ("SELECT batch_id, moneda_pago, count(*) AS rows FROM dv "
                                    "WHERE moneda_pago IS NOT NULL GROUP BY ALL")
    q["rows_by_day"] = full + "SELECT batch_id, dia_pago, count(*) AS rows FROM dv WHERE dia_pago IS NOT NULL GROUP BY ALL"
    q["amount_sums"] = plain + ("SELECT batch_id, " + ", ".join(f"{_money_sum(num_double(c))} AS sum_{c}" for c in DOUBLE_COLS)
                                + " FROM cl GROUP BY batch_id")
    units = ", ".join(f"CAST(sum(CAST({num_double(c)} * pow(2.0E0, 80) AS HUGEINT)) AS VARCHAR) AS sum_{c}" for c in DOUBLE_COLS)
    q["exact_sums"] = plain + f"SELECT batch_id, {units} FROM cl GROUP BY batch_id"
    cnt = ", ".join(f"count(*) FILTER (WHERE moneda_pago = '{c}') AS rows_{c.lower()}" for c in ("VES", "USD", "EUR", "COP"))
    q["batch_summary"] = full + (
        f"SELECT batch_id, count(*) AS total_filas, {DERIVED_WIDTH} AS total_columnas, {cnt}, "
        "count(*) FILTER (WHERE dia_pago = 'JUEVES') AS rows_jueves, count(*) FILTER (WHERE dia_pago = 'VIERNES') AS rows_viernes, "
        + ", ".join(f"{_money_sum(num_double(c))} AS sum_{c}" for c in DOUBLE_COLS)
        + f", {_money_sum('monto_final')} AS sum_monto_final, {_money_sum('monto_total_usd')} AS sum_monto_total_usd, "
        "max(ves) AS tasa_bolivares, max(ves5) AS tasa_bolivares_jueves, max(eur) AS tasa_euro, max(cop) AS tasa_cop "
        "FROM dv GROUP BY batch_id")
    # publishing
    q["renamed_output"] = full + f"SELECT {', '.join(_display_select())} FROM dv"
    from .operators.publish import CANONICAL_TO_DISPLAY
    disp_to_can = {d: c for c, d in CANONICAL_TO_DISPLAY.items()}
    ordered = ", ".join(f'{disp_to_can[d]} AS "{d}"' for d in R.OUTPUT_ORDER)
    q["ordered_output"] = full + f"SELECT batch_id, {ordered} FROM dv"
    q["warehouse_shape"] = full + f"SELECT {', '.join(_warehouse_select())} FROM dv"
    L, S = R.RATES_REPORT_LABELS, R.RATES_REPORT_SOURCES
    ves_src = f"CASE WHEN ves_answered THEN ves_source ELSE {lit(S[4])} END"
    eur_src = f"CASE WHEN eur_answered THEN {lit(EUR_SOURCE)} ELSE {lit(S[4])} END"
    rep = [f"SELECT batch_id, 0 AS n, {lit(L[0])} AS label, ves AS value, CAST(NULL AS VARCHAR) AS value_text, {ves_src} AS detail FROM rates",
           f"SELECT batch_id, 1, {lit(L[1])}, ves_thursday, NULL, {lit(S[1])} FROM rates",
           f"SELECT batch_id, 2, {lit(L[2])}, {float(R.THURSDAY_MARGIN)}E0, NULL, {lit(S[2])} FROM rates",
           f"SELECT batch_id, 3, {lit(L[3])}, eur, NULL, {eur_src} FROM rates",
           f"SELECT batch_id, 4, {lit(L[4])}, CAST(NULL AS DOUBLE), coalesce(ves_date, strftime(ves_at, '%Y-%m-%d')), "
           "strftime(ves_at, '%Y-%m-%dT%H:%M:%S') FROM rates"]
    q["rates_report"] = full + "\nUNION ALL\n".join(rep)
    local = f"timezone({lit(R.BUSINESS_TZ)}, timezone('UTC', TIMESTAMP '{RUN_TS}'))"
    day = f"strftime({local}, '%Y-%m-%d')"
    fname = f"{lit(R.FINAL_FILE_STEM)} || strftime({local}, '%Y%m%d_%H%M%S') || '.xlsx'"
    q["dated_runs"] = plain + (f"SELECT batch_id, {day} AS run_date, {fname} AS file_name, "
                               f"'logs/' || {day} || '/' || batch_id || '/' || {fname} AS path, count(*) AS rows "
                               "FROM cl GROUP BY batch_id")
    # sinks, and step 2 on what they wrote
    q["staged_sheet"] = q["ordered_output"]
    q["restaged_batches"] = full + ("SELECT batch_id, tipo_factura, count(*) AS rows FROM dv "
                                    "WHERE batch_id <> 'batch-1' OR tipo_factura = 'A' GROUP BY ALL")
    q["step2_shape"] = q["warehouse_shape"]
    q["warehouse_load"] = full + f"SELECT {', '.join(_warehouse_select()[1:])} FROM dv"
    q["load_report"] = full + """, n AS (SELECT count(*) AS n FROM dv)
        SELECT step, load_id, mode, n AS rows_uploaded, n * times AS rows_in_table
        FROM n, (VALUES (0, 'l1', 'empty', 1), (1, 'l2', 'append', 2), (2, 'l2', 'append', 2), (3, 'l3', 'append', 3),
                        (4, 'l4', 'replace', 1)) m(step, load_id, mode, times)"""
    stamp = f"strftime({local}, '%Y%m%d_%H%M%S')"
    q["run_output"] = full + (f"SELECT {day} AS run_date, {stamp} AS run_stamp, batch_id, count(*) AS rows, 'detail' AS part FROM dv GROUP BY batch_id "
                              f"UNION ALL SELECT {day}, {stamp}, NULL, 5 * count(*), 'rates' FROM rates "
                              f"UNION ALL SELECT {day}, {stamp}, NULL, count(*), 'areas' FROM areas")
    q["listing_totals"] = full + ("SELECT 1 AS total_fechas, count(DISTINCT batch_id) AS total_carpetas, 0 AS archivos_vacios, "
                                  "true AS en_cada_carpeta FROM dv")
    return q
