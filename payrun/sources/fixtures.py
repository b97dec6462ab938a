"""Invoice, area-lookup and quote tables derived from the driver's tables.

The same SQL text runs in Spark (over the parquet files) and in DuckDB (over
views of the same names), so the Spark operators and the DuckDB oracle see
identical inputs. Every view reads its whole source tables: rows are
reshaped with CASE expressions, never filtered out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..rules import EXPECTED_HEADERS
from ..session import compiled_apart

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


# Columns of the invoice view, in order (besides ``batch_id``).
INVOICE_COLUMNS = ("numero_factura", "numero_oc", "tipo_factura", "nombre_lote", "proveedor", "rif",
                   "fecha_documento", "tienda", "sucursal", "monto", "moneda", "fecha_vencimiento",
                   "cuenta", "prioridad", "monto_capex_ext", "monto_capex_ord", "monto_cadm", "solicitante")


def spark_refs(sf_dir: str) -> dict[str, str]:
    """Table name -> Spark SQL reference to its parquet file, and the order of the invoice view's joins."""
    return {t: f"parquet.`{sf_dir.rstrip('/')}/{t}.parquet`" for t in TABLES} | {"invoice_joins": ORDERS_FIRST}


def duck_refs() -> dict[str, str]:
    """Table name -> DuckDB view name (the driver registers the views)."""
    return {t: t for t in TABLES}


# Invoice rows: one per lineitem, with the 18 sheet columns the rules read.
# Text and number columns keep their source types; the operators coerce.
INVOICES_SQL = """
SELECT 'batch-' || CAST(l.l_orderkey % 4 AS STRING) AS batch_id,
 CASE WHEN l.l_orderkey % 97 = 0 THEN ' Total de Facturas ' WHEN l.l_orderkey % 89 = 0 THEN 'total'
      ELSE CAST(l.l_orderkey AS STRING) || '-' || CAST(l.l_linenumber AS STRING) END AS numero_factura,
 CAST(o.o_orderkey AS STRING) AS numero_oc, l.l_returnflag AS tipo_factura, o.o_orderpriority AS nombre_lote,
 CASE WHEN l.l_suppkey % 20 = 0 THEN 'RECARGAS MOVIL C.A' WHEN l.l_suppkey % 20 = 1 THEN 'Corporacion Digitel, C.A.'
      WHEN l.l_suppkey % 20 = 2 THEN 'NETUNO, C.A.' WHEN l.l_suppkey % 20 = 3 THEN 'TELEFÓNICA VENEZOLANA, C.A.'
      WHEN l.l_suppkey % 20 = 4 THEN 'RECARGAS' WHEN l.l_suppkey % 20 = 5 AND l.l_linenumber = 1 THEN NULL
      ELSE s.s_name END AS proveedor,
 'J-' || CAST(s.s_suppkey AS STRING) AS rif, CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS fecha_documento,
 n.n_name AS tienda,
 CASE WHEN l.l_linenumber % 4 = 0 THEN 'Pospago Factura' WHEN l.l_linenumber % 4 = 1 THEN 'RECARGAS'
      WHEN l.l_linenumber % 4 = 2 THEN 'PREPAGO RECARGA NORTE' ELSE 'SEDE ' || n.n_name END AS sucursal,
 l.l_extendedprice AS monto,
 CASE WHEN l.l_partkey % 7 = 0 THEN 'VES' WHEN l.l_partkey % 7 = 1 THEN ' usd ' WHEN l.l_partkey % 7 = 2 THEN 'USD'
      WHEN l.l_partkey % 7 = 3 THEN 'EUR' WHEN l.l_partkey % 7 = 4 THEN 'COP' WHEN l.l_partkey % 7 = 5 THEN 'GBP'
      ELSE NULL END AS moneda,
 CAST(CAST(l.l_shipdate AS DATE) AS STRING) AS fecha_vencimiento,
 CASE WHEN l.l_linenumber = 7 THEN NULL ELSE '0102-' || CAST(o.o_custkey AS STRING) END AS cuenta,
 CASE WHEN l.l_orderkey % 37 = 0 THEN 'n/d' WHEN l.l_orderkey % 41 = 0 THEN NULL
      ELSE CAST(60 + l.l_orderkey % 31 AS STRING) END AS prioridad,
 CASE WHEN l.l_linenumber % 3 = 0 THEN 0.0E0 ELSE l.l_extendedprice * l.l_discount END AS monto_capex_ext,
 CASE WHEN l.l_partkey % 4 < 2 THEN 0.0E0 ELSE l.l_extendedprice * l.l_tax END AS monto_capex_ord,
 CASE WHEN l.l_suppkey % 3 = 0 THEN 0.0E0 ELSE l.l_extendedprice * 5.0E-1 END AS monto_cadm,
 CASE WHEN o.o_custkey % 11 = 0 THEN '0' WHEN o.o_custkey % 13 = 0 THEN NULL WHEN o.o_custkey % 17 = 0 THEN '0.0'
      ELSE CAST(o.o_custkey AS STRING) END AS solicitante{extra}
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey
"""

# Spark joins in the order that is written, and lineitem is by far the longest table. So its
# orders get their customers first: the lines are shuffled once (by order), not by customer too.
LINES_FIRST = INVOICES_SQL[INVOICES_SQL.index("FROM {lineitem}"):]
ORDERS_FIRST = """FROM {lineitem} l
JOIN ({orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey) ON l.l_orderkey = o.o_orderkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
"""

# The same invoices as an export delivers them: amounts as text (some unreadable), empty
# texts of several kinds, rows without any value.
EMPTY_TEXTS = ("", "NA", "#N/A", "NULL", "n/a", "nan", "None", "-1.#IND", "<NA>")


SOURCE_KEYS = ", l.l_orderkey AS src_orderkey, l.l_linenumber AS src_linenumber"


def raw_cells() -> dict[str, str]:
    """Each cell of the export, from the invoice's column of that name and the line's keys."""
    def cell(i: int, c: str) -> str:
        empty = EMPTY_TEXTS[i % len(EMPTY_TEXTS)]
        if c.startswith("monto"):
            value = (f"CASE (src_orderkey + src_linenumber + {i}) % 41 WHEN 1 THEN 'n/d' WHEN 2 THEN '1,234' WHEN 3 THEN ' 12.50 ' WHEN 4 THEN '1e3' "
                     f"WHEN 5 THEN 'inf' WHEN 6 THEN '-.5' WHEN 7 THEN '1_000' ELSE {_num_text(c)} END")
        else:
            value = c
        return (f"CASE WHEN src_orderkey % 53 = 0 THEN {'NULL' if i % 2 else _q(empty)} "
                f"WHEN (src_orderkey + {i}) % 47 = 0 THEN {_q(empty)} WHEN (src_orderkey + {i}) % 59 = 0 THEN ' NA ' ELSE {value} END")

    return {c: cell(i, c) for i, c in enumerate(INVOICE_COLUMNS)}


def raw_invoices_sql(refs: dict[str, str]) -> str:
    cells = ", ".join(f"{cell} AS {c}" for c, cell in raw_cells().items())
    return f"SELECT batch_id, {cells} FROM ({invoices_sql(refs, SOURCE_KEYS)}) i"


# Many rules from the suppliers: names that lie in a provider's, that a provider's lies in, and neither.
MANY_ALWAYS_SQL = """
SELECT DISTINCT CASE WHEN s_suppkey % 4 = 0 THEN upper(s_name) || ', C.A.' WHEN s_suppkey % 4 = 1 THEN substr(upper(s_name), 10)
                ELSE replace(upper(s_name), '#', '-') END AS rule FROM {supplier}
"""
MANY_BRANCH_SQL = """
SELECT DISTINCT substr(upper(s_name), 12) AS provider, upper(n_name) AS branch FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
"""

# Area lookup over every customer. Keys are shaped, not filtered: one in
# five never matches a requester, some repeat the previous key (the later
# position wins), some carry spaces, some are null; some areas are null or
# the lower-case top-up text.
AREAS_SQL = """
SELECT c_custkey AS pos,
 CASE WHEN c_custkey % 37 = 0 THEN NULL
      WHEN c_custkey % 31 = 0 THEN ' ' || CAST(c_custkey AS STRING) || ' '
      WHEN c_custkey % 7 = 0 THEN CAST(c_custkey - 1 AS STRING)
      WHEN c_custkey % 5 = 0 THEN 'X-' || CAST(c_custkey AS STRING)
      ELSE CAST(c_custkey AS STRING) END AS codigo,
 CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 29 = 0 THEN 'recargas'
      ELSE c_mktsegment END AS area
FROM {customer}
"""

# One fetched answer per event: VES answers ({ves}: a landed quote object or a list),
# COP answers (object or list, several key shapes, some unreadable) and EUR answers (some
# broken). ``snap`` is the day; ``batch_id`` assigns each day's answers to a batch.
QUOTES_SQL = """
SELECT snap, 'batch-' || CAST(EXTRACT(DAY FROM snap) % 4 AS STRING) AS batch_id, pos, pair, fetched_at,
 CASE pair
  WHEN 'VES' THEN
{ves}
  WHEN 'COP' THEN
   CASE WHEN pos % 11 = 0 THEN '[]'
        ELSE CASE WHEN pos % 2 = 0 THEN '[' ELSE '' END
          || CASE WHEN pos % 5 = 0 THEN '{{"valor":' || v_cop || '}}'
                  WHEN pos % 5 = 1 THEN '{{"fuente":"Banco","compra":"' || v_cop || '"}}'
                  WHEN pos % 7 = 0 THEN '{{"nombre":"Oficial","promedio":' || v_cop || ',"compra":"n/d","venta":' || v_cop || '}}'
                  ELSE '{{"nombre":"Oficial","promedio":' || v_cop || ',"compra":' || v_cop || ',"venta":' || v_cop || '}}' END
          || CASE WHEN pos % 2 = 0 THEN ']' ELSE '' END END
  ELSE
   CASE WHEN pos % 13 = 0 THEN '{{"rates":'
        ELSE '{{"amount":1.0,"base":"EUR","date":"' || CAST(snap AS STRING) || '","rates":{{"USD":' || v_eur || '}}}}' END
 END AS payload
FROM (
 SELECT CAST(ts AS DATE) AS snap, event_id AS pos, ts AS fetched_at,
  CASE WHEN event_type IN ('purchase', 'view', 'click') THEN 'VES' WHEN event_type = 'signup' THEN 'COP'
       ELSE 'EUR' END AS pair,
  CASE event_type
   WHEN 'purchase' THEN CASE WHEN EXTRACT(DAY FROM ts) % 5 >= 2 THEN 'Dólar Oficial' ELSE 'Cripto' END
   WHEN 'view' THEN CASE WHEN EXTRACT(DAY FROM ts) % 5 >= 2 THEN 'BCV' ELSE 'Bitcoin' END
   WHEN 'click' THEN CASE WHEN EXTRACT(DAY FROM ts) % 5 >= 1 THEN 'Paralelo' ELSE 'Promedio' END
   ELSE NULL END AS nombre,
  CAST(CAST(value AS DECIMAL(12,2)) AS STRING) AS v2,
  CAST(CAST(value * 400 AS DECIMAL(14,2)) AS STRING) AS v_cop,
  CAST(CAST(value / 10 AS DECIMAL(12,4)) AS STRING) AS v_eur
 FROM {events}
) e
"""


# A landed VES quote object.
VES_OBJECT = """
   '{"nombre":"' || nombre || '",'
   || CASE WHEN pos % 10 = 0 THEN ''
           WHEN pos % 10 = 1 THEN '"promedio":null,'
           WHEN pos % 17 = 0 THEN '"promedio":"n/d",'
           WHEN pos % 3 = 0 THEN '"promedio":"' || replace(v2, '.', ',') || '",'
           ELSE '"promedio":"' || v2 || '",' END
   || '"compra":"' || v2 || '","venta":"' || v2 || '","fechaActualizacion":"' || CAST(snap AS STRING) || '"}'
"""

# A VES answer as the service gives it: a list of several quotes, of one, of none, a
# broken text, a quote without a name (or null for it), an empty quote, or no list of objects.
VES_LIST = """
   CASE pos % 11
    WHEN 0 THEN '[]'
    WHEN 1 THEN '[{"nombre":"' || nombre || '",'
    WHEN 2 THEN '[{"nombre":null,"promedio":"' || v2 || '"}]'
    WHEN 3 THEN '[{"compra":"' || v2 || '"}]'
    WHEN 4 THEN '["' || nombre || '"]'
    WHEN 5 THEN '[{},{"nombre":"' || nombre || '","promedio":' || v2 || '}]'
    WHEN 6 THEN '[{"nombre":"' || nombre || '","promedio":"n/d","compra":"' || v2 || '"}]'
    WHEN 7 THEN '[{"nombre":"' || nombre || '","compra":"' || replace(v2, '.', ',') || '","fechaActualizacion":"' || CAST(snap AS STRING) || 'T09:00:00"},'
         || '{"nombre":"Otro","promedio":1.5}]'
    ELSE '[{"nombre":"Cripto","promedio":"7"},{"nombre":"' || nombre || '","promedio":"' || v2 || '","fechaActualizacion":"' || CAST(snap AS STRING) || '"},'
         || '{"nombre":"' || nombre || ' 2","promedio":' || v_eur || '}]'
   END
"""


def invoices_sql(refs: dict[str, str], extra: str = "") -> str:
    return INVOICES_SQL.replace(LINES_FIRST, refs.get("invoice_joins", LINES_FIRST)).format(extra=extra, **refs)


def areas_sql(refs: dict[str, str]) -> str:
    return AREAS_SQL.format(**refs)


def quotes_sql(refs: dict[str, str]) -> str:
    return QUOTES_SQL.format(ves=VES_OBJECT.strip("\n"), **refs)


def answers_sql(refs: dict[str, str]) -> str:
    return QUOTES_SQL.format(ves=VES_LIST.strip("\n"), **refs)


def invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The view as if it were a stored table: its rows are counted (``observe``), and the
    optimizer moves no filter through a count. Otherwise it would merge a filter that
    names every cell with the CASE expressions that build the cells, and infer one more
    constraint for each subset of the columns; a stored table has no such expressions.
    """
    view = spark.sql(invoices_sql(spark_refs(sf_dir)))
    return view.observe("invoice_view", F.count(F.lit(1)).alias("rows"))


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(grid_sql(spark_refs(sf_dir), "array"))


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``invoices``, from the export's texts: the cells of ``raw_invoices_sql``, six at a
    time, compiled apart from each other and from the joins below."""
    view, cells = spark.sql(invoices_sql(spark_refs(sf_dir), SOURCE_KEYS)), list(raw_cells().items())
    for i in range(0, len(cells), 6):
        view = compiled_apart(view).withColumns({c: F.expr(cell) for c, cell in cells[i:i + 6]})
    return compiled_apart(view.select("batch_id", *INVOICE_COLUMNS))


def many_rules(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Provider rules (J2) and provider and branch rules (J3) as tables."""
    return tuple(spark.sql(q.format(**spark_refs(sf_dir))) for q in (MANY_ALWAYS_SQL, MANY_BRANCH_SQL))


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(areas_sql(spark_refs(sf_dir)))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(quotes_sql(spark_refs(sf_dir)))


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(answers_sql(spark_refs(sf_dir)))


# -- a sheet grid built from the invoices ------------------------------------
# Each batch becomes one exported sheet: data rows keep the invoice values as
# text (numbers as fixed-scale decimals, so both engines print them alike) at
# positions from row 30 on; a few header and title rows per batch exercise
# header detection:
#   batch-0  header in row 0                                   -> H1, row 0
#   batch-1  title in row 0, header in row 2 with a line break,
#            a repeated name, a blank name and spaces          -> H1, row 2
#   batch-2  title, a row of 12 numbers, a header with only 4 exact names (3 + "RIF")
#            in row 3                                          -> H2, row 3
#   batch-3  title only; the real header sits in row 25        -> H3, row 0

_EXPECTED = EXPECTED_HEADERS


def _q(v):
    return "NULL" if v is None else v if v.startswith("(") else "'" + v.replace("'", "''") + "'"


def _row(batch: str, idx: int, cells, arr: str) -> str:
    padded = list(cells) + [None] * (24 - len(cells))
    return f"SELECT '{batch}' AS batch_id, {idx} AS row_idx, {arr}({', '.join(_q(c) for c in padded)}) AS cells"


def _header_rows(arr: str) -> list[str]:
    quirky = list(_EXPECTED)
    quirky[0] = "('Numero de' || chr(10) || 'Factura')"
    quirky[9] = " Monto "
    quirky[13] = "Moneda"
    quirky[23] = None
    partial = [h if h in ("Numero de Factura", "Monto", "Moneda") else h.upper()
               for h in _EXPECTED]
    return [
        _row("batch-0", 0, _EXPECTED, arr),
        _row("batch-1", 0, ["Prioridades de Pago - Semana 1"], arr),
        _row("batch-1", 2, quirky, arr),
        _row("batch-2", 0, ["Reporte de prioridades"], arr),
        _row("batch-2", 1, [str(i) for i in range(1, 13)], arr),
        _row("batch-2", 3, partial, arr),
        _row("batch-3", 0, ["Prioridades", "Semana", "3"], arr),
        _row("batch-3", 25, _EXPECTED, arr),
    ]


def _num_text(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,6)) AS STRING)"


def grid_sql(refs: dict[str, str], arr: str) -> str:
    """``arr`` is the engine's array constructor (``array`` / ``list_value``)."""
    cells = ["numero_factura", "numero_oc", "tipo_factura", "nombre_lote", "proveedor", "rif",
             "fecha_documento", "tienda", "sucursal", _num_text("monto"), "moneda", "fecha_vencimiento",
             "cuenta", "NULL", "NULL", "NULL", "NULL", "prioridad", _num_text("monto_capex_ext"),
             _num_text("monto_capex_ord"), _num_text("monto_cadm"), "NULL", "solicitante", "NULL"]
    data = (f"SELECT batch_id, 30 + (src_orderkey - src_orderkey % 4) * 2 + src_linenumber AS row_idx, "
            f"{arr}({', '.join(cells)}) AS cells FROM ({invoices_sql(refs, SOURCE_KEYS)}) i")
    return "\nUNION ALL\n".join([data] + _header_rows(arr))
