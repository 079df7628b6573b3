"""Income and expense consolidation from the two projection tabs of every finance workbook.

Per sheet (all sheets in one job): find the header with a keyword radar (first 15 rows, else
row 0), name the columns (strip, blanks → ``column_i``, collisions → ``_n``), map them to
canonical names (dictionary, prefix rules, ``_dupN``), then per row: unified date, ghost-row
purge, status filter, amount parsing and positivity, expense date requirement. Every
"if the column exists" decision is per sheet, from the layout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sheetfold.functions import text as T
from sheetfold.operators import headers as H
from sheetfold.operators import layout as L
from sheetfold.operators.joins import materialize
from sheetfold.operators.ranges import parse_range

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------------------------
INCOME, EXPENSE = "Ingreso", "Gasto"
INCOME_TAB, EXPENSE_TAB = "Proyección - Ingresos", "Proyección - Gastos"
FINANCE_NAME_PREFIX, COPY_MARKER = "NUEVO", "COPIA"
MASTER_ORDER = [
    "archivo_origen", "Tipo_Movimiento", "Fecha", "Proyecto", "País de facturación",
    "Categoría", "Tipo de gasto", "Descripción", "Producto/Entregable/Servicio",
    "Monto sin Impuestos", "IGV/IVA/Otros", "Monto con Impuestos",
    "Moneda", "TC", "USD", "Fecha de entrega del producto",
    "Fecha de emisión del comprobante", "Situación", "Fecha de factura proveedor",
]
INCOME_DICTIONARY = {"Proyecto / Cuenta analítica": "Proyecto", "2": "Proyecto"}
INCOME_COLUMNS = [
    "Fecha", "Proyecto", "País de facturación", "Producto/Entregable/Servicio",
    "Monto sin Impuestos", "IGV/IVA/Otros", "Monto con Impuestos",
    "Moneda", "TC", "USD", "Fecha de entrega del producto",
    "Fecha de emisión del comprobante", "Situación",
]
EXPENSE_DICTIONARY = {"Monto Total / (Monto sin Impuestos)": "Monto sin Impuestos", "SItuación": "Situación"}
EXPENSE_COLUMNS = [
    "Fecha", "Proyecto", "País de facturación", "Categoría", "Tipo de gasto",
    "Descripción", "Fecha de factura proveedor", "Monto sin Impuestos",
    "IGV/IVA/Otros", "Monto con Impuestos", "Moneda", "TC", "USD", "Situación",
]
HEADER_KEYWORDS = ["PROYECTO", "MONTO", "SITUACI", "FACTURA"]
HEADER_SEARCH_ROWS = 15
RANGE = "A:Z"  # of both projection tabs
VALID_STATUS = ["REAL", "PROYECTADO"]
INCOME_DATE, EXPENSE_DATE = "Fecha de emisión del comprobante", "Fecha de factura proveedor"
GHOST_KEY_COLUMNS = ["Proyecto", "Situación", "Monto con Impuestos", "Descripción", "Fecha"]
# ---------------------------------------------------------------------------------------------

RANGE_COLUMNS = parse_range(RANGE).n_cols
#: Every canonical column a row projection may need (in master order).
_NEEDED = [c for c in MASTER_ORDER if c not in ("archivo_origen", "Tipo_Movimiento", "Fecha")]


def _map(d: dict[str, str]) -> Column:
    items = []
    for k, v in d.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def prefix_rules() -> list:
    """Canonical-name rules tried in order (upper-case prefixes; the literal name ``2``)."""
    return [
        (lambda c: T.upper(c).startswith("PROYECTO"), "Proyecto"),
        (lambda c: (c == "2") | T.upper(c).startswith("MONTO SIN"), "Monto sin Impuestos"),
        (lambda c: T.upper(c).startswith("MONTO CON"), "Monto con Impuestos"),
        (lambda c: T.upper(c).startswith("SITUACI"), "Situación"),
    ]


def canonical(names: Column, tipo: Column) -> Column:
    dictionary = F.when(tipo == INCOME, _map(INCOME_DICTIONARY)).otherwise(_map(EXPENSE_DICTIONARY))
    return H.canonical_names(names, dictionary, prefix_rules())


def finance_name_ok(name: Column) -> Column:
    """Case-insensitive: the workbook name starts with ``NUEVO`` and is not a copy."""
    u = T.upper(name)
    return u.startswith(FINANCE_NAME_PREFIX) & ~u.contains(COPY_MARKER)


def finance_file_filter(listing: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Keep the listing rows whose workbook name passes :func:`finance_name_ok`."""
    return listing.where(finance_name_ok(F.col(name_col)))


def finance_layout(grid: DataFrame, keys: list[str], tipo_col: str) -> DataFrame:
    """Per sheet: header position (radar), width, names, canonical names, and the 0-based position
    ``i_<k>`` of every canonical column the rows need (null = column absent in that sheet)."""
    lay = L.sheet_layout(grid, _with_tipo(keys, tipo_col), HEADER_KEYWORDS, HEADER_SEARCH_ROWS, fallback_first_row=True)
    lay = lay.withColumn("names", H.dedupe_checked(H.pad_header(F.col("header"), F.col("width"))))
    lay = lay.withColumn("canon", canonical(F.col("names"), F.col(tipo_col)))
    return lay.withColumns({f"i_{k}": H.position_of(F.col("canon"), F.lit(c)) for k, c in enumerate(_NEEDED)})


def _with_tipo(keys: list[str], tipo_col: str) -> list[str]:
    """Sheet keys plus the tab-type column (constant within a sheet)."""
    return keys if tipo_col in keys else keys + [tipo_col]


def _present(name: str) -> Column:
    return F.col(f"i_{_NEEDED.index(name)}").isNotNull()


def _value(name: str) -> Column:
    return L.cell_at(F.col("cells"), F.col(f"i_{_NEEDED.index(name)}"))


def unified_date(tipo: Column, income_date: Column, expense_date: Column) -> Column:
    """Income ← voucher issue date, expense ← supplier invoice date, else '' (a null argument
    means the column is absent in that sheet)."""
    return (F.when((tipo == INCOME) & income_date.isNotNull(), income_date)
            .when((tipo == EXPENSE) & expense_date.isNotNull(), expense_date)
            .otherwise(F.lit("")))


def ghost_keep(values: list[Column]) -> Column:
    """Keep a row when some *present* key column is non-blank (absent columns are null)."""
    return _any([F.coalesce(T.strip(v) != "", F.lit(False)) for v in values])


def _any(conds: list[Column]) -> Column:
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out


def status_ok(status: Column) -> Column:
    """Status, upper-cased and stripped, is REAL or PROYECTADO (absent column: no filter)."""
    return F.when(status.isNull(), F.lit(True)).otherwise(T.strip(T.upper(status)).isin(*VALID_STATUS))


def usd_ok(usd_number: Column, present: Column) -> Column:
    """USD parses and is positive (absent column: no filter)."""
    return F.when(~present, F.lit(True)).otherwise(F.coalesce(usd_number > 0, F.lit(False)))


def gross_ok(gross_text: Column) -> Column:
    """Gross amount's cleaned text is non-empty and parses positive (absent column: no filter)."""
    cleaned = T.amount_eu_text(gross_text)
    return F.when(gross_text.isNull(), F.lit(True)).otherwise(
        F.coalesce((cleaned != "") & (T.try_double(cleaned) > 0), F.lit(False)))


def expense_date_ok(tipo: Column, fecha: Column) -> Column:
    """Expense rows need a non-blank date."""
    return F.when(tipo != EXPENSE, F.lit(True)).otherwise(
        F.coalesce((T.strip(fecha) != "") & fecha.isNotNull(), F.lit(False)))


def clean_rows(rows: DataFrame, keys: list[str], tipo_col: str, title_col: str, order_col: str | None = None) -> DataFrame:
    """Project the canonical columns of each data row and flag it:
    ``_real`` (survives the ghost purge) and ``_valid`` (survives every filter). ``order_col``: the
    position of a row's workbook in the listing, carried as ``_file_ord``."""
    tipo = F.col(tipo_col)
    fecha = unified_date(tipo, _value(INCOME_DATE), _value(EXPENSE_DATE))
    cols = {c: _value(c) for c in _NEEDED}
    cols["Fecha"] = fecha
    usd = T.amount_eu(cols["USD"])
    real = ghost_keep([cols[c] for c in GHOST_KEY_COLUMNS])
    valid = (real & status_ok(cols["Situación"]) & usd_ok(usd, _present("USD"))
             & gross_ok(cols["Monto con Impuestos"]) & expense_date_ok(tipo, fecha))
    key_cols = [k for k in keys if k not in ("archivo_origen", "Tipo_Movimiento")]
    order = [F.col(order_col).alias("_file_ord")] if order_col else []
    out = rows.select(*key_cols, *order, "row_idx", tipo.alias("Tipo_Movimiento"), F.col(title_col).alias("archivo_origen"),
                      *[v.alias(k) for k, v in cols.items() if k != "USD"], usd.alias("USD"),
                      real.alias("_real"), valid.alias("_valid"))
    return out


def clean_grids(grid: DataFrame, keys: list[str], tipo_col: str, title_col: str, order_col: str | None = None) -> DataFrame:
    """Raw projection tabs → flagged rows (see :func:`clean_rows`).

    The positions of the needed columns, and whether a row follows the header, show in the rows of
    the header search and the one behind; only those are aggregated (the filter reaches the scan)."""
    lay = finance_layout(grid.where(F.col("row_idx") <= HEADER_SEARCH_ROWS), keys, tipo_col)
    gkeys = _with_tipo(keys, tipo_col)
    slim = lay.select(*gkeys, "header_idx", "stop_idx", *[f"i_{k}" for k in range(len(_NEEDED))])
    rows = L.table_rows(grid, slim, gkeys)
    return clean_rows(rows, keys, tipo_col, title_col, order_col)


def _select(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in cols])


#: A bit per column of the masters.
_BITS = {c: 1 << i for i, c in enumerate(MASTER_ORDER)}


def presence(tipo: str) -> Column:
    """Aggregate over cleaned rows: the bits of the columns that some sheet of this type with a valid row
    has. A cell of a column that a sheet lacks is null, and ``USD`` of a valid row is null only then."""
    own = INCOME_COLUMNS if tipo == INCOME else EXPENSE_COLUMNS
    bits = F.lit(0)
    for c in own:
        bits = bits + F.when(F.col(f"`{c}`").isNotNull(), F.lit(_BITS[c])).otherwise(0)
    return F.coalesce(F.bit_or(F.when(F.col("_valid") & (F.col("Tipo_Movimiento") == tipo), bits)), F.lit(0))


def present_columns(bits: dict[str, int]) -> dict[str, list[str]]:
    """Columns that each export has: those of its type that some sheet had, in the export's own order,
    and for ``Base_Looker`` those of either type in master order."""
    has = {t: [c for c in cols if bits[t] & _BITS[c]] for t, cols in ((INCOME, INCOME_COLUMNS), (EXPENSE, EXPENSE_COLUMNS))}
    tags = ["Tipo_Movimiento", "archivo_origen"]
    return {"Ingresos": has[INCOME] + tags, "Gastos": has[EXPENSE] + tags,
            "Base_Looker": [c for c in MASTER_ORDER if c in tags or c in has[INCOME] or c in has[EXPENSE]]}


def masters(clean: DataFrame, present: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """``Ingresos``, ``Gastos`` and ``Base_Looker`` (master order) from flagged rows; with ``present``
    (:func:`present_columns`) without the columns that no sheet had.

    ``Base_Looker`` is the by-name union of the two masters written as one projection (a column
    only one tab type exports is null on the other type's rows), so the cleaned rows are read
    once rather than once per union branch. Where rows carry ``_file_ord`` the tables are in the
    order of the listing: income before expense, workbooks as listed, rows as in their sheet. The sort is
    range-partitioned on all three, so neither a large workbook nor a large sheet is one task.
    """
    tags = ["Tipo_Movimiento", "archivo_origen"]
    present = present or {"Ingresos": INCOME_COLUMNS + tags, "Gastos": EXPENSE_COLUMNS + tags, "Base_Looker": MASTER_ORDER}
    valid = clean.where("_valid")
    tipo = F.col("Tipo_Movimiento")

    def listed(df: DataFrame) -> DataFrame:
        return df.orderBy(tipo != INCOME, "_file_ord", "row_idx") if "_file_ord" in df.columns else df

    def pick(c: str) -> Column:
        col = F.col(f"`{c}`")
        if c in tags or (c in INCOME_COLUMNS and c in EXPENSE_COLUMNS):
            return col.alias(c)
        if c in INCOME_COLUMNS:
            return F.when(tipo == INCOME, col).alias(c)
        if c in EXPENSE_COLUMNS:
            return F.when(tipo == EXPENSE, col).alias(c)
        return F.lit(None).cast("string").alias(c)

    base = listed(valid.where(tipo.isin(INCOME, EXPENSE))).select(*[pick(c) for c in present["Base_Looker"]])
    return {"Ingresos": _select(listed(valid.where(tipo == INCOME)), present["Ingresos"]),
            "Gastos": _select(listed(valid.where(tipo == EXPENSE)), present["Gastos"]), "Base_Looker": base}


def audit(clean: DataFrame, keys: list[str]) -> DataFrame:
    """Per sheet: rows after the ghost purge and rows that pass every filter (one pass)."""
    key_cols = [k for k in keys if k not in ("archivo_origen", "Tipo_Movimiento")]
    return clean.groupBy("archivo_origen", "Tipo_Movimiento", *key_cols).agg(
        F.count(F.when(F.col("_real"), 1)).alias("n_real"),
        F.count(F.when(F.col("_valid"), 1)).alias("n_valid"))


def cleaned(grid: DataFrame, keys: list[str], tipo_col: str, title_col: str,
            order_col: str | None = None) -> tuple[DataFrame, dict[str, list[str]]]:
    """The flagged rows, written once, and the columns that the exports have: the write itself observes
    which columns some sheet had (one number per type), so no second pass looks for them."""
    rows = clean_grids(grid, keys, tipo_col, title_col, order_col)
    seen = Observation()
    rows = materialize(rows.observe(seen, presence(INCOME).alias(INCOME), presence(EXPENSE).alias(EXPENSE)))
    bits = seen.get
    return rows, present_columns({t: int(bits[t]) for t in (INCOME, EXPENSE)})


def run(grid: DataFrame, keys: list[str], tipo_col: str, title_col: str, order_col: str | None = None) -> dict[str, DataFrame]:
    """Whole job on raw projection tabs: the three masters plus the audit table. The flagged rows
    feed all four outputs and are written once. The masters lack the columns that no sheet had; with
    ``order_col`` (a workbook's position in the listing) they are in listing order."""
    clean, present = cleaned(grid, keys, tipo_col, title_col, order_col)
    out = masters(clean, present)
    out["Auditoria"] = audit(clean, keys)
    return out
