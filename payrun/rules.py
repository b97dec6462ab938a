"""Business rules of a payment batch, as plain data.

Every public function of the package takes a ``PayRules`` so a caller can
change a list or a default without touching code; ``DEFAULT_RULES`` holds
the values the source system uses.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# FIXED VALUES -- these must equal the source system's rules for the results
# to match. They are listed as text, in the order the source states them.
# ---------------------------------------------------------------------------

# The 24 column headers an invoice sheet is expected to carry.
EXPECTED_HEADERS = (
    "Numero de Factura",
    "Numero de OC",
    "Tipo Factura",
    "Nombre Lote",
    "Proveedor",
    "RIF",
    "Fecha Documento",
    "Tienda",
    "Sucursal",
    "Monto",
    "Moneda",
    "Fecha Vencimiento",
    "Cuenta",
    "Banco",
    "Id Cta",
    "Método de Pago",
    "Pago Independiente",
    "Prioridad",
    "Monto CAPEX EXT",
    "Monto CAPEX ORD",
    "Monto CADM",
    "Fecha Creación",
    "Solicitante",
    "Proveedor Remito",
)

# Priorities that keep USD as the payment currency.
USD_PAY_PRIORITIES = (69, 70, 71, 72, 73, 74, 75, 76, 77, 87, 86, 88, 84, 85)
# Priorities that keep the original account when the currency is USD.
USD_KEEP_ACCOUNT_PRIORITIES = (69, 70, 71, 72, 73, 74, 75, 76, 77, 87, 86, 88, 83, 84, 85)
# Account used for USD invoices outside the list above.
DEFAULT_USD_ACCOUNT = "1111"
# Priorities whose amount is paid as is, without conversion.
NO_CONVERSION_PRIORITIES = (67, 69, 70, 71, 72, 73, 74, 75, 76, 77, 87, 86, 88, 83, 84, 85, 89)
# Added to the VES rate for payments made on Thursday.
THURSDAY_MARGIN = 5
# Rates used when a quote is missing, zero or unreadable.
DEFAULT_VES_RATE = 36.50
DEFAULT_EUR_RATE = 1.10
DEFAULT_COP_RATE = 0.00024

# Providers that are always top-up ("RECARGAS") business.
ALWAYS_RECARGAS_PROVIDERS = (
    "GALAXY ENTERTAINMENT DE VENEZUELA, C.A. (SIMPLE TV )",
    "RECARGAS MOVIL C.A",
)
# Providers that are top-up business only for the listed branches.
BRANCH_RECARGAS_PROVIDERS = (
    ("CORPORACION DIGITEL, C.A.", ("POSPAGO FACTURA", "PREPAGO RECARGA")),
    ("NETUNO, C.A.", ("RECARGAS",)),
    ("TELEFÓNICA VENEZOLANA, C.A.", ("RECARGAS",)),
    ("TELEFONICA VENEZOLANA, C.A.", ("RECARGAS",)),
)

# Invoice-number texts that mark a summary row, not an invoice.
SUMMARY_ROW_CONTAINS = ("TOTAL DE FACTURAS", "TOTAL FACTURAS")
SUMMARY_ROW_EQUALS = "TOTAL"

# Header search: rows looked at, known names needed, fallback shape.
HEADER_SEARCH_ROWS = 20
HEADER_MIN_MATCHES = 5
FALLBACK_MIN_CELLS = 10
FALLBACK_TEXT_SHARE = 0.5

# Display names given to columns in the processed sheet.
RENAME_OUTPUT = (
    ("Tipo Factura", "Tipo factura"),
    ("Id Cta", "CODIGO CTA"),
    ("Método de Pago", "METODO DE PAGO"),
    ("Prioridad", "Prioridad origen"),
    ("Monto Capex ORD 2", "MONTO CAPEX ORD2"),
    ("Monto Capex EXT 3", "MONTO CAPEX EXT3"),
    ("Monto Capex Final", "MONTO CAPEX FINAL"),
    ("Monto Opex Final", "MONTO OPEX FINAL"),
    ("Dia de Pago", "Día de pago"),
    ("Monto Capex ORD USD", "MONTO CAPEX ORD USD"),
    ("Monto Capex EXT USD", "MONTO CAPEX EXT USD"),
    ("Monto Total USD", "MONTO TOTAL USD"),
    ("AREA", "ÁREA"),
    ("Tipo Capex", "TIPO CAPEX"),
    ("Tipo Capex 2", "CAPEX"),
)

# The 38 columns of the processed sheet, in order (display names).
OUTPUT_ORDER = (
    "Numero de Factura",
    "Numero de OC",
    "Tipo factura",
    "Nombre Lote",
    "Proveedor",
    "RIF",
    "Fecha Documento",
    "Tienda",
    "Sucursal",
    "Monto",
    "Moneda",
    "Fecha Vencimiento",
    "Cuenta",
    "CODIGO CTA",
    "METODO DE PAGO",
    "Pago Independiente",
    "Prioridad origen",
    "Monto CAPEX EXT",
    "Monto CAPEX ORD",
    "Monto CADM",
    "Fecha Creación",
    "Solicitante",
    "MONTO CAPEX ORD2",
    "MONTO CAPEX EXT3",
    "MONTO CAPEX FINAL",
    "MONTO OPEX FINAL",
    "Moneda Pago",
    "Monto Final",
    "Cuenta Bancaria",
    "Día de pago",
    "MONTO CAPEX ORD USD",
    "MONTO CAPEX EXT USD",
    "Monto CAPEX USD",
    "Monto OPEX USD",
    "MONTO TOTAL USD",
    "ÁREA",
    "TIPO CAPEX",
    "CAPEX",
)

# Warehouse column names (without prefix) for the 38 display names.
WAREHOUSE_NAMES = (
    ("Numero de Factura", "numero_factura"),
    ("Numero de OC", "numero_oc"),
    ("Tipo factura", "tipo_factura"),
    ("Nombre Lote", "nombre_lote"),
    ("Proveedor", "proveedor"),
    ("RIF", "rif"),
    ("Fecha Documento", "fecha_documento"),
    ("Tienda", "tienda"),
    ("Sucursal", "sucursal"),
    ("Monto", "monto"),
    ("Moneda", "moneda"),
    ("Fecha Vencimiento", "fecha_vencimiento"),
    ("Cuenta", "cuenta"),
    ("CODIGO CTA", "codigo_cuenta"),
    ("METODO DE PAGO", "metodo_pago"),
    ("Pago Independiente", "pago_independiente"),
    ("Prioridad origen", "prioridad_origen"),
    ("Monto CAPEX EXT", "monto_capex_ext"),
    ("Monto CAPEX ORD", "monto_capex_ord"),
    ("Monto CADM", "monto_cadm"),
    ("Fecha Creación", "fecha_creacion"),
    ("Solicitante", "solicitante"),
    ("MONTO CAPEX ORD2", "monto_capex_ord_2"),
    ("MONTO CAPEX EXT3", "monto_capex_ext_3"),
    ("MONTO CAPEX FINAL", "monto_capex_final"),
    ("Moneda Pago", "moneda_pago"),
    ("Monto Final", "monto_final"),
    ("Cuenta Bancaria", "cuenta_bancaria"),
    ("Día de pago", "dia_pago"),
    ("MONTO CAPEX ORD USD", "monto_capex_ord_usd"),
    ("MONTO CAPEX EXT USD", "monto_capex_ext_usd"),
    ("Monto CAPEX USD", "monto_capex_usd"),
    ("Monto OPEX USD", "monto_opex_usd"),
    ("MONTO OPEX FINAL", "monto_opex_final"),
    ("MONTO TOTAL USD", "monto_total_usd"),
    ("ÁREA", "area"),
    ("TIPO CAPEX", "tipo_capex"),
    ("CAPEX", "tipo_capex_2"),
)

# Texts a spreadsheet reader takes for an empty cell.
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")

# Payment days and capex kinds produced by the rules.
THURSDAY, FRIDAY, TUESDAY = "JUEVES", "VIERNES", "MARTES"
RECARGAS, SERVICIOS = "RECARGAS", "SERVICIOS"

# Date formats tried, in order, when a date column is parsed.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "dd/MM/yyyy", "yyyy/MM/dd", "dd-MM-yyyy")

# Time zone of the business (run dates and file stamps).
BUSINESS_TZ = "America/Caracas"

# Rates report: row labels and source texts, in report order.
RATES_REPORT_LABELS = (
    "Tasa VES/USD",
    "Tasa VES/USD + 5",
    "Margen día JUEVES",
    "Tasa EUR/USD",
    "Fecha consulta",
)
# Sources that a rate carries where its answer names none.
VES_SOURCE, COP_SOURCE, EUR_SOURCE = "DolarAPI Venezuela", "DolarAPI Colombia", "Frankfurter API (ECB)"
RATES_REPORT_SOURCES = ("DolarAPI", "Calculada (Tasa + 5)", "Configuración", "Frankfurter", "Por defecto")

# Name stems of the processed and final files of a run.
PROCESSED_FILE_STEM = "Prioridades_Pago_Procesado_"
FINAL_FILE_STEM = "Prioridades_Pago_Final_"
NO_DATE_FOLDER = "sin_fecha"

# ---------------------------------------------------------------------------
# Canonical (snake_case) column names used inside the package.
# ---------------------------------------------------------------------------

# Expected header text -> canonical input column.
HEADER_TO_COLUMN = (
    ("Numero de Factura", "numero_factura"),
    ("Numero de OC", "numero_oc"),
    ("Tipo Factura", "tipo_factura"),
    ("Nombre Lote", "nombre_lote"),
    ("Proveedor", "proveedor"),
    ("RIF", "rif"),
    ("Fecha Documento", "fecha_documento"),
    ("Tienda", "tienda"),
    ("Sucursal", "sucursal"),
    ("Monto", "monto"),
    ("Moneda", "moneda"),
    ("Fecha Vencimiento", "fecha_vencimiento"),
    ("Cuenta", "cuenta"),
    ("Banco", "banco"),
    ("Id Cta", "codigo_cuenta"),
    ("Método de Pago", "metodo_pago"),
    ("Pago Independiente", "pago_independiente"),
    ("Prioridad", "prioridad"),
    ("Monto CAPEX EXT", "monto_capex_ext"),
    ("Monto CAPEX ORD", "monto_capex_ord"),
    ("Monto CADM", "monto_cadm"),
    ("Fecha Creación", "fecha_creacion"),
    ("Solicitante", "solicitante"),
    ("Proveedor Remito", "proveedor_remito"),
)

INPUT_COLUMNS = tuple(c for _, c in HEADER_TO_COLUMN)
AMOUNT_COLUMNS = ("monto", "monto_capex_ext", "monto_capex_ord", "monto_cadm")
DATE_COLUMNS = ("fecha_documento", "fecha_vencimiento", "fecha_creacion")

# Derived columns, in the order the rules compute them.
DERIVED_COLUMNS = (
    "moneda_pago",
    "cuenta_bancaria",
    "dia_pago",
    "monto_final",
    "monto_capex_final",
    "monto_opex_final",
    "area",
    "tipo_capex_2",
    "tipo_capex",
    "monto_capex_ord_2",
    "monto_capex_ext_3",
    "monto_capex_ord_usd",
    "monto_capex_ext_usd",
    "monto_capex_usd",
    "monto_opex_usd",
    "monto_total_usd",
)

# Canonical name of each display column of OUTPUT_ORDER.
DISPLAY_TO_COLUMN = (
    tuple((h, c) for h, c in HEADER_TO_COLUMN if h not in dict(RENAME_OUTPUT))
    + (
        ("Tipo factura", "tipo_factura"),
        ("CODIGO CTA", "codigo_cuenta"),
        ("METODO DE PAGO", "metodo_pago"),
        ("Prioridad origen", "prioridad"),
        ("MONTO CAPEX ORD2", "monto_capex_ord_2"),
        ("MONTO CAPEX EXT3", "monto_capex_ext_3"),
        ("MONTO CAPEX FINAL", "monto_capex_final"),
        ("MONTO OPEX FINAL", "monto_opex_final"),
        ("Moneda Pago", "moneda_pago"),
        ("Monto Final", "monto_final"),
        ("Cuenta Bancaria", "cuenta_bancaria"),
        ("Día de pago", "dia_pago"),
        ("MONTO CAPEX ORD USD", "monto_capex_ord_usd"),
        ("MONTO CAPEX EXT USD", "monto_capex_ext_usd"),
        ("Monto CAPEX USD", "monto_capex_usd"),
        ("Monto OPEX USD", "monto_opex_usd"),
        ("MONTO TOTAL USD", "monto_total_usd"),
        ("ÁREA", "area"),
        ("TIPO CAPEX", "tipo_capex"),
        ("CAPEX", "tipo_capex_2"),
    )
)

# Rate columns carried by every row after the rate join.
RATE_COLUMNS = ("tasa_bolivares", "tasa_bolivares_jueves", "tasa_euro", "tasa_cop")


@dataclass(frozen=True)
class PayRules:
    """All tunable rules in one value; defaults are the fixed values above."""

    expected_headers: tuple = EXPECTED_HEADERS
    usd_pay_priorities: tuple = USD_PAY_PRIORITIES
    usd_keep_account_priorities: tuple = USD_KEEP_ACCOUNT_PRIORITIES
    default_usd_account: str = DEFAULT_USD_ACCOUNT
    no_conversion_priorities: tuple = NO_CONVERSION_PRIORITIES
    thursday_margin: float = THURSDAY_MARGIN
    default_ves_rate: float = DEFAULT_VES_RATE
    default_eur_rate: float = DEFAULT_EUR_RATE
    default_cop_rate: float = DEFAULT_COP_RATE
    always_recargas_providers: tuple = ALWAYS_RECARGAS_PROVIDERS
    branch_recargas_providers: tuple = BRANCH_RECARGAS_PROVIDERS
    # Q1: a blank provider text is contained in every rule text, so it
    # matches; keep that unless a caller asks for non-blank matches only.
    require_nonblank_match: bool = False
    summary_row_contains: tuple = SUMMARY_ROW_CONTAINS
    summary_row_equals: str = SUMMARY_ROW_EQUALS
    header_search_rows: int = HEADER_SEARCH_ROWS
    header_min_matches: int = HEADER_MIN_MATCHES
    fallback_min_cells: int = FALLBACK_MIN_CELLS
    fallback_text_share: float = FALLBACK_TEXT_SHARE
    null_tokens: tuple = NULL_TOKENS
    date_formats: tuple = DATE_FORMATS
    business_tz: str = BUSINESS_TZ
    warehouse_prefix: str = ""
    extra: dict = field(default_factory=dict)

    @property
    def default_ves_thursday_rate(self) -> float:
        return self.default_ves_rate + self.thursday_margin


DEFAULT_RULES = PayRules()
