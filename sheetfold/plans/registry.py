"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Each reads the driver's test tables through the stand-in views of
:mod:`sheetfold.sources.fixtures` and runs the library's own operators on them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetfold.functions import text as T
from sheetfold.operators import headers as H
from sheetfold.operators import layout as L
from sheetfold.operators.joins import materialize, missing_from, sized_side
from sheetfold.plans import budget as BU
from sheetfold.plans import finance as FI
from sheetfold.plans import timesheets as TS
from sheetfold.operators.ranges import read_range
from sheetfold.operators.rowid import dense_index
from sheetfold.session import ensure_checkpoint_dir
from sheetfold.sources import grid as G
from sheetfold.sources import listing as LS
from sheetfold.sources import sinks as SK
from sheetfold.sources.catalog import Folder
from sheetfold.sources.exports import csv_line, write_workbook_exports
from sheetfold.sources.fixtures import fx, lines_to_cells

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _c(name: str):
    return F.col(f"`{name}`")


# ---- scalar functions ---------------------------------------------------------------------

@query("fn_strip_unicode")
def fn_strip_unicode(spark, sf):
    """Unicode strip on finance text columns."""
    f = fx(spark, sf, "fx_finance")
    return f.select("o_orderkey", T.strip(_c("Situación")).alias("situacion"),
                    T.strip(F.col("fecha_doc")).alias("fecha"))


@query("fn_case")
def fn_case(spark, sf):
    """Upper and lower case of the finance status text."""
    f = fx(spark, sf, "fx_finance")
    return f.select("o_orderkey", T.upper(_c("Situación")).alias("up"), T.lower(_c("Situación")).alias("low"))


@query("fn_startswith_contains")
def fn_startswith_contains(spark, sf):
    """Prefix test on budget workbook titles; substring test on upper-cased person names."""
    b = fx(spark, sf, "fx_budget")
    n = _c("Nombre completo")
    return b.select("row_idx", T.starts_with(F.col("file_name"), "Productividad: 2024").alias("starts"),
                    T.contains(T.upper(n), "INSERTAR").alias("has_insertar"))


@query("fn_replace_first")
def fn_replace_first(spark, sf):
    """First ',' → '.' in USD text and first '.' → ',' in gross-amount text."""
    f = fx(spark, sf, "fx_finance")
    return f.select("o_orderkey", T.replace_first(F.col("USD"), ",", ".").alias("usd_first"),
                    T.replace_first(_c("Monto con Impuestos"), ".", ",").alias("gross_first"))


@query("fn_replace_all")
def fn_replace_all(spark, sf):
    """Regex removal of non-amount characters from USD text; literal removal of every '.' in gross amounts."""
    f = fx(spark, sf, "fx_finance")
    return f.select("o_orderkey",
                    T.regex_replace_all(F.col("USD"), r"[^0-9,.]", "").alias("usd_kept"),
                    T.replace_all(_c("Monto con Impuestos"), ".", "").alias("gross_nodots"))


@query("fn_title_clean")
def fn_title_clean(spark, sf):
    """Budget project name from the workbook title (prefix removed everywhere, stripped)."""
    b = fx(spark, sf, "fx_budget").select("file_ord", "file_name").distinct()
    return b.select("file_ord", T.strip(T.remove_literal(F.col("file_name"), "Productividad: ")).alias("Proyecto"))


@query("fn_try_double")
def fn_try_double(spark, sf):
    """Non-strict numeric cast of the raw hours text."""
    t = fx(spark, sf, "fx_timesheet")
    return t.select("event_id", T.try_double(_c("Cantidad de horas")).alias("raw_double"))


@query("fn_amount_eu")
def fn_amount_eu(spark, sf):
    """European amounts parsed from USD and gross-amount text."""
    f = fx(spark, sf, "fx_finance")
    return f.select("o_orderkey", T.amount_eu(F.col("USD")).alias("usd"),
                    T.amount_eu(_c("Monto con Impuestos")).alias("gross"))


@query("fn_hours")
def fn_hours(spark, sf):
    """Hours text with a decimal comma parsed to double."""
    t = fx(spark, sf, "fx_timesheet")
    return t.select("event_id", T.hours(_c("Cantidad de horas")).alias("horas"))


# ---- timesheets ---------------------------------------------------------------------------

def _ts_clean(spark, sf):
    return TS.clean_sector(fx(spark, sf, "fx_timesheet"))


def _ts_flagged(spark, sf):
    costed = TS.cost_rows(_ts_clean(spark, sf), TS.staff_rates(fx(spark, sf, "fx_rates")))
    return TS.alert_flags(costed, fx(spark, sf, "fx_projects"))


@query("ts_parse_dates")
def ts_parse_dates(spark, sf):
    """Timesheet dates parsed with the seven formats; ISO text, else the original text."""
    t = fx(spark, sf, "fx_timesheet")
    d = T.parse_date_multi(_c("Fecha"))
    return t.select("event_id", d.alias("fecha_date"), T.iso_or_text(d, _c("Fecha")).alias("Fecha"))


@query("ts_month_label")
def ts_month_label(spark, sf):
    """Month label ('ene/2025') of the parsed date, else the original month text."""
    t = fx(spark, sf, "fx_timesheet")
    d = T.parse_date_multi(_c("Fecha"))
    return t.select("event_id", F.when(d.isNotNull(), T.month_label(d)).otherwise(_c("Mes")).alias("Mes"))


@query("ts_project_id")
def ts_project_id(spark, sf):
    """Stripped project and the project id taken from the unstripped text."""
    return _ts_clean(spark, sf).select("event_id", "Proyecto", "proyecto_id")


@query("ts_person_name")
def ts_person_name(spark, sf):
    """Person from the workbook title (text after the last '-')."""
    t = fx(spark, sf, "fx_timesheet")
    return t.select("event_id", T.last_dash_part(F.col("archivo_origen")).alias("nombre"))


@query("ts_nonempty_rows")
def ts_nonempty_rows(spark, sf):
    """Cleaned timesheet rows that survive the non-empty-row rule."""
    return _ts_clean(spark, sf).select("event_id", "nombre", "Fecha", "Mes", _c("Cantidad de horas"))


@query("dim_rates_ts")
def dim_rates_ts(spark, sf):
    """Timesheet rates dimension (exact names, unusable rates → 0.0)."""
    return TS.staff_rates(fx(spark, sf, "fx_rates"))


@query("join_rates_exact")
def join_rates_exact(spark, sf):
    """Left join of cleaned rows with rates on the exact name (duplicates fan out)."""
    out = TS.cost_rows(_ts_clean(spark, sf), TS.staff_rates(fx(spark, sf, "fx_rates")))
    return out.select("event_id", "nombre", _c("Costo interno"))


@query("ts_cost")
def ts_cost(spark, sf):
    """Row cost (hours / 8) × rate, with an unmatched rate counted as 0."""
    out = TS.cost_rows(_ts_clean(spark, sf), TS.staff_rates(fx(spark, sf, "fx_rates")))
    return out.select("event_id", "nombre", _c("Cantidad de horas"), _c("Costo interno"), "costo_rate_interno")


@query("ts_membership_check")
def ts_membership_check(spark, sf):
    """Project-name alert from membership in the project master."""
    return _ts_flagged(spark, sf).select("event_id", "Proyecto", "alerta_proyecto_nomb")


@query("ts_alert_flags")
def ts_alert_flags(spark, sf):
    """The six row alerts and their sum."""
    return _ts_flagged(spark, sf).select("event_id", *TS.ALERT_COLUMNS, "suma_alertas")


@query("ts_alert_detail")
def ts_alert_detail(spark, sf):
    """Rows with at least one alert, sorted by person."""
    return TS.alert_detail(_ts_flagged(spark, sf))


@query("ts_alert_summary")
def ts_alert_summary(spark, sf):
    """Per-person alert counts, latest date text and stale-date alert, sorted by alert count."""
    return TS.alert_summary(_ts_flagged(spark, sf))


@query("ts_consolidated")
def ts_consolidated(spark, sf):
    """The consolidated timesheet table with rates and costs."""
    costed = TS.cost_rows(_ts_clean(spark, sf), TS.staff_rates(fx(spark, sf, "fx_rates")))
    return TS.consolidated(costed)


# ---- grids: shared stand-ins --------------------------------------------------------------

BUDGET_KEYS = ["file_ord"]
FINANCE_KEYS = ["archivo_origen", "tipo"]


def _grid_budget(spark, sf):
    return lines_to_cells(fx(spark, sf, "fx_grid_budget"))


def _grid_finance(spark, sf):
    return lines_to_cells(fx(spark, sf, "fx_grid_finance"))


def _line(c):
    return F.array_join(c, "|")


def _team_layout(spark, sf, require_data=True):
    return BU.team_layout(L.blank_error_cells(_grid_budget(spark, sf)), BUDGET_KEYS, require_data=require_data)


# ---- sources ------------------------------------------------------------------------------

@query("src_listing")
def src_listing(spark, sf):
    """The listings of two configured folders, one given by its URL, one by its id, appended in that order."""
    rows = fx(spark, sf, "fx_listing")
    folders = ["https://files.example.org/drive/folders/finance-a?usp=sharing", "finance-b"]
    parts = [rows.where(F.col("file_ord") % 2 == k).withColumn("folder", F.lit(LS.folder_id(f))) for k, f in enumerate(folders)]
    lst = LS.ordered_listing(LS.append_listings(parts).drop("file_ord"), [LS.folder_id(f) for f in folders])
    return lst.select("folder", "file_id", "file_ord", "file_name")


@query("src_dedupe_by_id")
def src_dedupe_by_id(spark, sf):
    """Workbook listing de-duplicated by id (last record, first position)."""
    return LS.dedupe_by_id(fx(spark, sf, "fx_listing"))


@query("src_name_filter_ci")
def src_name_filter_ci(spark, sf):
    """Finance name filter (case-insensitive) applied after de-duplication by id."""
    return FI.finance_file_filter(LS.dedupe_by_id(fx(spark, sf, "fx_listing")))


@query("src_name_filter_cs")
def src_name_filter_cs(spark, sf):
    """Timesheet name filter (case-sensitive prefix, no templates)."""
    return TS.timesheet_file_filter(fx(spark, sf, "fx_listing"))


@query("src_range_az")
def src_range_az(spark, sf):
    """Finance grids read as range A:Z (first 26 columns)."""
    g = L.slice_range(_grid_finance(spark, sf), n_cols=FI.RANGE_COLUMNS)
    return g.select(*FINANCE_KEYS, "row_idx", F.size("cells").alias("n_cells"), _line("cells").alias("line"))


@query("src_range_a2i")
def src_range_a2i(spark, sf):
    """Budget grids read as range A2:I (row 1 skipped, nine columns)."""
    g = L.slice_range(_grid_budget(spark, sf), first_row=1, n_cols=9)
    return g.select(*BUDGET_KEYS, "row_idx", F.size("cells").alias("n_cells"), _line("cells").alias("line"))


# ---- grid layout --------------------------------------------------------------------------

@query("grid_blank_errors")
def grid_blank_errors(spark, sf):
    """Budget grid rows with error cells ('#…') blanked."""
    g = L.blank_error_cells(_grid_budget(spark, sf))
    return g.select(*BUDGET_KEYS, "row_idx", _line("cells").alias("line_clean"))


@query("grid_header_radar")
def grid_header_radar(spark, sf):
    """Finance header row found by the keyword radar (first 15 rows, else row 0)."""
    lay = FI.finance_layout(_grid_finance(spark, sf), FINANCE_KEYS, "tipo")
    return lay.select(*FINANCE_KEYS, "header_idx", _line("header").alias("header_line"))


@query("grid_header_required")
def grid_header_required(spark, sf):
    """Budget header row: first of 30 rows holding NOMBRE COMPLETO; sheets without one dropped."""
    lay = _team_layout(spark, sf, require_data=False)
    return lay.select(*BUDGET_KEYS, "header_idx", _line("header").alias("header_line"))


@query("grid_carve_until")
def grid_carve_until(spark, sf):
    """Budget table carved from the header to the first TOTAL / EQUIPO EXTERNO row."""
    lay = _team_layout(spark, sf, require_data=False)
    return lay.select(*BUDGET_KEYS, "header_idx", "stop_idx", "n_data")


@query("grid_min_rows")
def grid_min_rows(spark, sf):
    """Budget sheets that have a table (at least two rows and a row under the header)."""
    lay = _team_layout(spark, sf, require_data=True)
    return lay.select(*BUDGET_KEYS, "n_rows", "n_data")


@query("grid_pad_widen")
def grid_pad_widen(spark, sf):
    """Budget table width (header vs longest carved row) and the padded, de-duplicated names."""
    g = L.blank_error_cells(_grid_budget(spark, sf))
    lay = L.carved_width(g, BU.team_layout(g, BUDGET_KEYS), BUDGET_KEYS)
    names = H.dedupe_checked(H.pad_header(F.col("header"), F.col("width")))
    return lay.select(*BUDGET_KEYS, "width", _line(names).alias("names_line"))


@query("grid_pad_truncate")
def grid_pad_truncate(spark, sf):
    """Rows padded or cut to the first-row header width."""
    g = _grid_budget(spark, sf)
    lay = L.first_row_layout(g, BUDGET_KEYS)
    rows = L.table_rows(g, lay.select(*BUDGET_KEYS, "header_idx", "stop_idx", F.size("header").alias("_w")), BUDGET_KEYS)
    return rows.select(*BUDGET_KEYS, "row_idx", _line(L.fit_cells(F.col("cells"), F.col("_w"))).alias("line_fit"))


def _long_table(rows, keys, names_col, width_col):
    cells = L.fit_cells(F.col("cells"), F.col(width_col))
    z = F.arrays_zip(F.col(names_col).alias("name"), cells.alias("value"))
    return rows.select(*keys, "row_idx", F.posexplode(z).alias("col_idx", "nv")).select(
        *keys, "row_idx", "col_idx", F.col("nv.name").alias("col_name"), F.col("nv.value").alias("value"))


@query("grid_to_table_ts")
def grid_to_table_ts(spark, sf):
    """Whole tab, header in row 0, counter names, rows fitted to the header (long form)."""
    g = _grid_budget(spark, sf)
    lay = L.first_row_layout(g, BUDGET_KEYS).withColumn("names", H.dedupe_counter(F.col("header")))
    lay = lay.where(~H.has_duplicates(F.col("names")))
    rows = L.table_rows(g, lay.select(*BUDGET_KEYS, "header_idx", "stop_idx", "names",
                                      F.size("names").alias("_w")), BUDGET_KEYS)
    return _long_table(rows, BUDGET_KEYS, "names", "_w")


@query("grid_to_table_fin")
def grid_to_table_fin(spark, sf):
    """Finance tabs as (row, canonical column, value) — every data row, padded to the width."""
    g = _grid_finance(spark, sf)
    lay = FI.finance_layout(g, FINANCE_KEYS, "tipo")
    rows = L.table_rows(g, lay.select(*FINANCE_KEYS, "header_idx", "stop_idx", "canon", "width"), FINANCE_KEYS)
    return _long_table(rows, FINANCE_KEYS, "canon", "width")


# ---- header naming ------------------------------------------------------------------------

@query("hdr_dedupe_checked")
def hdr_dedupe_checked(spark, sf):
    """Finance header names: stripped, blanks named column_i, collisions suffixed with the first free _n."""
    lay = FI.finance_layout(_grid_finance(spark, sf), FINANCE_KEYS, "tipo")
    return lay.select(*FINANCE_KEYS, "width", _line("names").alias("names_line"))


@query("hdr_dedupe_counter")
def hdr_dedupe_counter(spark, sf):
    """Counter naming of budget headers (_n by occurrence) and whether names collide."""
    lay = _team_layout(spark, sf, require_data=False)
    names = H.dedupe_counter(F.col("header"))
    return lay.select(*BUDGET_KEYS, _line(names).alias("names_line"), H.has_duplicates(names).alias("rejected"))


@query("hdr_canonical")
def hdr_canonical(spark, sf):
    """Finance canonical column names (dictionary, prefix rules, _dupN)."""
    lay = FI.finance_layout(_grid_finance(spark, sf), FINANCE_KEYS, "tipo")
    return lay.select(*FINANCE_KEYS, _line("canon").alias("canon_line"))


@query("hdr_keyword_lookup")
def hdr_keyword_lookup(spark, sf):
    """Budget name and hours columns found by keyword, with their positions."""
    lay = _team_layout(spark, sf, require_data=False)
    return lay.select(*BUDGET_KEYS, "col_nombre", "i_nombre", "col_horas", "i_horas")


@query("ts_rename_if_present")
def ts_rename_if_present(spark, sf):
    """Timesheet range read (A2:I) with the project / sequence renames, on raw grids."""
    rows, _ = TS.read_timesheet_grids(lines_to_cells(fx(spark, sf, "fx_grid_timesheet")), ["file_name"])
    return rows.select("file_name", "row_idx", "consecutivo", "Proyecto", _c("Cantidad de horas"))


# ---- budget -------------------------------------------------------------------------------

def _budget_people(spark, sf):
    b = fx(spark, sf, "fx_budget")
    return BU.people_rows(b, _c("Nombre completo"), _c("Cantidad de horas"), "file_name",
                          keep_cols=["file_ord", "row_idx"])


def _budget_rates(spark, sf):
    return BU.budget_rates(fx(spark, sf, "fx_rates"))


@query("budget_person_filter")
def budget_person_filter(spark, sf):
    """Budget person rows: non-blank, no INSERTAR, hours that parse."""
    return _budget_people(spark, sf).select("file_ord", "row_idx", "nombre", "Horas_Presupuestadas")


@query("budget_project_id")
def budget_project_id(spark, sf):
    """Budget project and project id (dashes → '_', all-digit ids quoted)."""
    b = fx(spark, sf, "fx_budget").select("file_ord", "file_name").distinct()
    p = BU.project_from_title(F.col("file_name"))
    return b.select("file_ord", p.alias("Proyecto"), BU.budget_project_id(p).alias("proyecto_id"))


@query("tag_literals")
def tag_literals(spark, sf):
    """Workbook title and project tags on budget person rows."""
    return _budget_people(spark, sf).select("file_ord", "row_idx", "archivo_origen", "Proyecto")


@query("budget_row_id")
def budget_row_id(spark, sf):
    """Dense budget row ids in file-then-row order."""
    return BU.number_rows(_budget_people(spark, sf), ["file_ord", "row_idx"]).select(
        "ID_Presupuesto", "file_ord", "row_idx", "proyecto_id")


@query("dim_rates_budget")
def dim_rates_budget(spark, sf):
    """Budget rates dimension (keyword-picked columns, stripped names, cleaned rates)."""
    return _budget_rates(spark, sf)


@query("join_rates_normalised")
def join_rates_normalised(spark, sf):
    """Left join of numbered budget rows with rates on lower(strip(name))."""
    numbered = BU.number_rows(_budget_people(spark, sf), ["file_ord", "row_idx"])
    return BU.cost(numbered, _budget_rates(spark, sf)).select("ID_Presupuesto", "nombre", "Costo_interno")


@query("budget_cost")
def budget_cost(spark, sf):
    """Budget cost (hours / 8) × rate, null when unmatched."""
    numbered = BU.number_rows(_budget_people(spark, sf), ["file_ord", "row_idx"])
    return BU.cost(numbered, _budget_rates(spark, sf)).select(
        "ID_Presupuesto", "nombre", "Horas_Presupuestadas", "Costo_interno", "Costo_Total_Proyecto")


@query("join_rates_missing")
def join_rates_missing(spark, sf):
    """Budget fact without a usable rates table (both cost columns null)."""
    return BU.fact_table(_budget_people(spark, sf), None, ["file_ord", "row_idx"])


@query("budget_fact")
def budget_fact(spark, sf):
    """Fact_Presupuesto_Horas end to end from raw ``Equipo`` grids and the rates table."""
    people = BU.extract_team(_grid_budget(spark, sf), BUDGET_KEYS, "file_name", ["file_ord", "row_idx"])
    return BU.fact_table(people, _budget_rates(spark, sf), ["file_ord", "row_idx"])


@query("dq_missing_files")
def dq_missing_files(spark, sf):
    """Listed budget workbooks that produced no table."""
    listed = fx(spark, sf, "fx_budget").select("file_ord", "file_name").distinct()
    people = materialize(BU.extract_team(_grid_budget(spark, sf), BUDGET_KEYS, "file_name", ["file_ord", "row_idx"]))
    return missing_from(listed, people, "file_ord")


# ---- finance ------------------------------------------------------------------------------

def _fin_clean(spark, sf):
    return FI.clean_grids(_grid_finance(spark, sf), FINANCE_KEYS, "tipo", "archivo_origen")


def _fx_fin_flags(spark, sf):
    """Filters on the typed finance stand-in (``fecha_doc`` is the type's own date column)."""
    f = fx(spark, sf, "fx_finance")
    tipo = F.col("Tipo_Movimiento")
    fecha = FI.unified_date(tipo, F.col("fecha_doc"), F.col("fecha_doc"))
    usd_text = F.when(F.col("has_usd"), F.col("USD"))
    usd = T.amount_eu(usd_text)
    real = FI.ghost_keep([_c("Proyecto"), _c("Situación"), _c("Monto con Impuestos"), fecha])
    return f.select("o_orderkey", "archivo_origen", "Tipo_Movimiento", fecha.alias("Fecha"), _c("Situación"),
                    usd.alias("USD"), real.alias("_real"),
                    FI.status_ok(_c("Situación")).alias("_status"),
                    (FI.usd_ok(usd, F.col("has_usd")) & FI.gross_ok(_c("Monto con Impuestos"))).alias("_amount"),
                    FI.expense_date_ok(tipo, fecha).alias("_date"))


@query("fin_ghost_rows")
def fin_ghost_rows(spark, sf):
    """Finance rows with some non-blank key column."""
    return _fx_fin_flags(spark, sf).where("_real").select("o_orderkey", "archivo_origen")


@query("fin_status_in")
def fin_status_in(spark, sf):
    """Finance rows (after the ghost purge) whose status is REAL or PROYECTADO."""
    return _fx_fin_flags(spark, sf).where("_real and _status").select("o_orderkey", _c("Situación"))


@query("fin_amount_positive")
def fin_amount_positive(spark, sf):
    """Finance rows (after ghost and status filters) whose USD, when present, and gross amount parse positive."""
    return _fx_fin_flags(spark, sf).where("_real and _status and _amount").select("o_orderkey", "USD")


@query("fin_expense_date")
def fin_expense_date(spark, sf):
    """Finance rows after every filter, including the expense-date requirement."""
    return (_fx_fin_flags(spark, sf).where("_real and _status and _amount and _date")
            .select("o_orderkey", "Tipo_Movimiento", "Fecha"))


@query("fin_unified_date")
def fin_unified_date(spark, sf):
    """Unified Fecha of every finance data row (per tab type, else '')."""
    return _fin_clean(spark, sf).select("archivo_origen", "Tipo_Movimiento", "row_idx", "Fecha")


@query("fin_optional_columns")
def fin_optional_columns(spark, sf):
    """Per-sheet presence: tabs without a USD column skip the USD filter and carry null USD."""
    return (_fin_clean(spark, sf).where("_valid")
            .select("archivo_origen", "Tipo_Movimiento", "row_idx", "USD", _c("Monto con Impuestos")))


@query("fin_clean")
def fin_clean(spark, sf):
    """Cleaned finance rows from raw tabs."""
    return (_fin_clean(spark, sf).where("_valid")
            .select("archivo_origen", "Tipo_Movimiento", "row_idx", "Fecha", "Proyecto", _c("Situación"),
                    _c("Monto con Impuestos"), "USD", _c("Fecha de emisión del comprobante"),
                    _c("Fecha de factura proveedor")))


@query("fin_master_order")
def fin_master_order(spark, sf):
    """Base_Looker: income and expense masters in master column order."""
    return FI.masters(_fin_clean(spark, sf))["Base_Looker"]


@query("union_by_name_missing")
def union_by_name_missing(spark, sf):
    """Income and expense frames with different columns, unioned by name (absent → null)."""
    f = fx(spark, sf, "fx_finance")
    inc = f.where(F.col("Tipo_Movimiento") == FI.INCOME).select(
        "o_orderkey", "Tipo_Movimiento", F.col("fecha_doc").alias(FI.INCOME_DATE), "Proyecto")
    exp = f.where(F.col("Tipo_Movimiento") == FI.EXPENSE).select(
        "o_orderkey", "Tipo_Movimiento", F.col("fecha_doc").alias(FI.EXPENSE_DATE), _c("Situación"))
    return inc.unionByName(exp, allowMissingColumns=True)


@query("audit_counts")
def audit_counts(spark, sf):
    """Per finance tab: rows after the ghost purge and valid rows."""
    return FI.audit(_fin_clean(spark, sf), FINANCE_KEYS)


# ---- sinks --------------------------------------------------------------------------------

@query("sink_null_to_blank")
def sink_null_to_blank(spark, sf):
    """Alert detail in export form (all text, null as '')."""
    return SK.null_to_blank(TS.alert_detail(_ts_flagged(spark, sf)))


@query("sink_dates_to_text")
def sink_dates_to_text(spark, sf):
    """Parsed timesheet dates exported as text."""
    t = fx(spark, sf, "fx_timesheet")
    return SK.dates_to_text(t.select("event_id", T.parse_date_multi(_c("Fecha")).alias("fecha_date")))


# ---- timesheets from raw grids ------------------------------------------------------------

def _ts_grid_rows(spark, sf):
    """Listing filter (case-sensitive prefix, no templates) before any sheet work, then the
    ``A2:I`` read with header naming and renames; the folder gives ``Sector_Origen``."""
    grid = lines_to_cells(fx(spark, sf, "fx_grid_timesheet"))
    grid = TS.timesheet_file_filter(grid, "file_name")
    rows, _ = TS.read_timesheet_grids(grid, ["file_name"], "file_name", sector_col="sector")
    return rows.drop("file_name")


@query("ts_grid_consolidated")
def ts_grid_consolidated(spark, sf):
    """Consolidated timesheet table end to end from raw ``Timesheet`` tabs."""
    costed = TS.cost_rows(TS.clean_sector(_ts_grid_rows(spark, sf)), TS.staff_rates(fx(spark, sf, "fx_rates")))
    return TS.consolidated(costed)


@query("ts_grid_alert_summary")
def ts_grid_alert_summary(spark, sf):
    """Per-person alert summary end to end from raw ``Timesheet`` tabs."""
    costed = TS.cost_rows(TS.clean_sector(_ts_grid_rows(spark, sf)), TS.staff_rates(fx(spark, sf, "fx_rates")))
    return TS.alert_summary(TS.alert_flags(costed, fx(spark, sf, "fx_projects")))


@query("audit_counts_ts")
def audit_counts_ts(spark, sf):
    """Per sector: timesheet rows read and rows kept by the non-empty-row rule."""
    return TS.audit(fx(spark, sf, "fx_timesheet"))


@query("src_listing_folders")
def src_listing_folders(spark, sf):
    """The workbooks of the three timesheet folders, listed folder after folder (positions
    continue across folders)."""
    books = fx(spark, sf, "fx_grid_timesheet").select(F.col("sector").alias("folder"), "file_name").distinct()
    return LS.ordered_listing(books, ["Empresarial", "Desarrollo", "Directorio"]).select("folder", "file_name", "file_ord")


# ---- real files: exports written to the shared folder and read back ------------------------

def _shared(spark, tag: str) -> str:
    """A new folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def _finance_exports(spark, sf) -> str:
    root = _shared(spark, "exports-finance")
    write_workbook_exports(_grid_finance(spark, sf).select(
        F.lit("Presupuestos").alias("folder"), F.col("archivo_origen").alias("file_name"),
        F.when(F.col("tipo") == FI.INCOME, F.lit(FI.INCOME_TAB)).otherwise(F.lit(FI.EXPENSE_TAB)).alias("tab"),
        "row_idx", "cells"), root)
    return root


def _timesheet_exports(spark, sf) -> str:
    root = _shared(spark, "exports-timesheets")
    write_workbook_exports(lines_to_cells(fx(spark, sf, "fx_grid_timesheet")).select(
        F.col("sector").alias("folder"), "file_name", F.lit("Timesheet").alias("tab"), "row_idx", "cells"), root)
    return root


@query("src_export_listing")
def src_export_listing(spark, sf):
    """Exported timesheet workbooks and their tabs, listed from file metadata."""
    return G.list_workbook_exports(spark, [_timesheet_exports(spark, sf)]).select("folder", "file_name", "tab").distinct()


@query("src_export_range")
def src_export_range(spark, sf):
    """The range ``'Proyección - Ingresos'!A:Z`` of exported finance workbooks with a name that the job takes."""
    grid = G.read_workbook_exports(spark, [_finance_exports(spark, sf)], max_cols=FI.RANGE_COLUMNS, tabs=[FI.INCOME_TAB],
                                   title_filter=FI.finance_name_ok)
    rows = read_range(grid, f"'{FI.INCOME_TAB}'!{FI.RANGE}")
    return rows.select("folder", "file_name", "row_idx", F.size("cells").alias("n_cells"), _line("cells").alias("line"))


@query("src_export_table")
def src_export_table(spark, sf):
    """Exported timesheet tabs read as ``A2:I`` tables, with the project and sequence renames."""
    grid = G.read_workbook_exports(spark, [_timesheet_exports(spark, sf)], tabs=["Timesheet"])
    rows, _ = TS.read_timesheet_grids(grid, ["file_name"])
    return rows.select("file_name", "row_idx", "consecutivo", "Proyecto", _c("Cantidad de horas"))


@query("dq_unreadable_files")
def dq_unreadable_files(spark, sf):
    """Exported budget workbooks, some of them broken on disk (NUL bytes, another encoding, an unclosed
    quote): the rows that each one gives, or the reason why it gives none."""
    grid = _grid_budget(spark, sf).withColumn("tab", F.lit(BU.TEAM_TAB)).withColumn("folder", F.lit("books"))
    text, kind = csv_line(F.col("cells")), F.col("file_ord") % 10
    latin = F.encode(F.concat(text, F.lit("ñ")), "ISO-8859-1").cast("string")
    line = (F.when(kind == 3, latin).when(kind == 5, F.concat(text, F.lit(',"')))
            .when(kind == 7, F.concat(text, F.lit("\0"))).otherwise(text))
    root = _shared(spark, "exports-broken")
    write_workbook_exports(grid, root, line)
    scan = G.scan_workbook_exports(spark, [root], tabs=[BU.TEAM_TAB])
    counts = scan.grid.groupBy("file_name").agg(F.count(F.lit(1)).alias("n_rows"))
    listed = G.list_workbook_exports(spark, [root]).select("file_name").distinct()
    return (listed.join(sized_side(counts), "file_name", "left")
            .join(sized_side(scan.failures.select("file_name", "reason")), "file_name", "left")
            .select("file_name", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "reason"))


# ---- finance exports ----------------------------------------------------------------------

@query("fin_present_columns")
def fin_present_columns(spark, sf):
    """Base_Looker without the columns that no sheet had."""
    clean, present = FI.cleaned(_grid_finance(spark, sf), FINANCE_KEYS, "tipo", "archivo_origen")
    return FI.masters(clean, present)["Base_Looker"]


@query("fin_export_order")
def fin_export_order(spark, sf):
    """Base_Looker exported in listing order and read back file by file: each row's place in the export."""
    out = FI.run(_grid_finance(spark, sf), FINANCE_KEYS, "tipo", "archivo_origen", order_col="archivo_origen")
    path = _shared(spark, "export-order")
    SK.write_table(out["Base_Looker"], path)
    back = SK.read_table(spark, path).select("archivo_origen", "Tipo_Movimiento", "Fecha", _c("Monto con Impuestos"),
                                             F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return dense_index(back, ["_file", "_row"], "position").drop("_file", "_row")


@query("ts_run_audit")
def ts_run_audit(spark, sf):
    """The timesheet run's per-sector audit, counted from the rows that the run has written."""
    return TS.run_audit(TS.flagged_rows(fx(spark, sf, "fx_timesheet"), fx(spark, sf, "fx_rates"), fx(spark, sf, "fx_projects")))


# ---- sinks: what a table holds after each step ----------------------------------------------

def _steps(spark, steps: list[tuple[str, int | None, int]]) -> DataFrame:
    """One row per step: what the write said and the rows that the table then holds."""
    return spark.createDataFrame(steps, "step string, written long, held long")


@query("sink_replace")
def sink_replace(spark, sf):
    """A table replaced in two phases: written, a run that dies before it publishes, the next run."""
    people, rates = _budget_people(spark, sf), fx(spark, sf, "fx_rates")
    path = _shared(spark, "sink-replace")

    def held():
        return SK.read_table(spark, path).count()
    steps = [("first", SK.write_table(people, path), held())]
    steps.append(("died before publishing", SK.stage(rates, f"{path}-staged", "parquet"), held()))
    steps.append(("next", SK.write_table(rates, path), held()))
    return _steps(spark, steps)


@query("sink_skip_empty")
def sink_skip_empty(spark, sf):
    """An empty result leaves the table as it was, unless asked to replace it."""
    people = _budget_people(spark, sf)
    none = people.where("file_ord is null")
    path = _shared(spark, "sink-skip")

    def held():
        return SK.read_table(spark, path).count()
    return _steps(spark, [("first", SK.write_table(people, path), held()), ("empty", SK.write_table(none, path), held()),
                          ("empty, replacing", SK.write_table(none, path, skip_empty=False), held())])


@query("sink_protected")
def sink_protected(spark, sf):
    """Writes into a protected folder, below it and above it are refused and change nothing."""
    people = _budget_people(spark, sf)
    root = _shared(spark, "sink-protected")
    source = f"{root}/source"
    SK.write_table(people, f"{source}/table")

    def refused(path):
        try:
            return SK.write_table(people.limit(1), path, protected=[source])
        except SK.ProtectedDestination:
            return None
    return _steps(spark, [(step, refused(path), SK.read_table(spark, f"{source}/table").count()) for step, path in
                          [("the folder", source), ("below", f"{source}/table"), ("above", root), ("beside", f"{root}/other")]])


@query("sink_find_or_create")
def sink_find_or_create(spark, sf):
    """Exports found by name in two folders: created where missing, replaced where there, apart by folder."""
    people, rates = _budget_people(spark, sf), fx(spark, sf, "fx_rates")
    tag = uuid.uuid4().hex
    a, b = (Folder(spark, f"{k} {tag}", _shared(spark, "folder")) for k in "ab")
    name = "Fact Presupuesto/Horas"
    steps = []
    for label, folder, df in [("a", a, people), ("b", b, rates), ("a again", a, rates), ("a empty", a, rates.limit(0))]:
        did, rows = folder.save(df, name)
        steps.append((f"{label}: {did}", rows, folder.find(name).count()))
    return _steps(spark, steps)
