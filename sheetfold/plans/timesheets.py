"""Timesheet consolidation, costing and data-quality alerts.

Input: the consolidated timesheet rows (one per sheet row; every cell is text), a rates table
(``Nombre``, ``Costo interno``) and a project master (``Tipo de proyecto``, ``Nombre de
Proyecto``, ``Activo``). :func:`read_timesheet_grids` builds the rows from raw grids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetfold.functions import text as T
from sheetfold.operators import headers as H
from sheetfold.operators import layout as L
from sheetfold.operators.joins import flag_membership, left_join_small, materialize
from sheetfold.operators.ranges import read_range

# ---------------------------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------------------------
REVIEW_DATE = "2025-02-28"
TIMESHEET_NAME_PREFIX = "Timesheet 2026 -"
TEMPLATE_MARKER = "Plantilla"
OTHER_PROJECT = "Otro"
PROJECTS_CATEGORY = "Proyectos"
ALERT_COLUMNS = ["alerta_category", "alerta_subcat", "alerta_proyectos", "alerta_horas",
                 "alerta_desc", "alerta_proyecto_nomb"]
DETAIL_COLUMNS = ["archivo_origen", "nombre", "consecutivo", "Fecha", "Día", "Category",
                  "Sub-Category", "Proyecto", "Descripción", "Cantidad de horas", "Mes",
                  "alerta_category", "alerta_subcat", "alerta_proyectos", "alerta_horas",
                  "alerta_desc", "alerta_proyecto_nomb", "suma_alertas"]
SUMMARY_COLUMNS = ["nombre", "alerta_category", "alerta_subcat", "alerta_proyectos",
                   "alerta_horas", "alerta_desc", "alerta_fecha", "alerta_proyecto_nomb",
                   "max_fecha", "suma_alertas"]
CONSOLIDATED_COLUMNS = ["archivo_origen", "nombre", "consecutivo", "Fecha", "Día", "Category",
                        "Sub-Category", "Proyecto", "Descripción", "Cantidad de horas", "Mes",
                        "Costo interno", "costo_rate_interno", "Sector_Origen"]
RANGE = "A2:I"
#: Columns a timesheet tab is read with (:data:`RANGE`): nine text columns.
TIMESHEET_TEXT_COLUMNS = ["consecutivo", "Fecha", "Día", "Category", "Sub-Category", "Proyecto",
                          "Descripción", "Cantidad de horas", "Mes"]
#: Columns read without a presence check: a sector where no file has one of these fails the run;
#: the next three must exist in some file of any sector.
REQUIRED_PER_SECTOR = ["Proyecto", "Cantidad de horas", "Fecha", "Mes", "Descripción", "Category"]
REQUIRED_ANYWHERE = ["Sub-Category", "consecutivo", "Día"]
#: Header renames: the project column's other name; the unnamed first column.
PROJECT_ALIASES = ["Proyecto", "Nombre de Proyecto"]
SEQUENCE_ALIASES = ["consecutivo", "...1", "Unnamed"]
# ---------------------------------------------------------------------------------------------


def _c(name: str):
    return F.col(f"`{name}`")


def timesheet_name_ok(name, prefix: str = TIMESHEET_NAME_PREFIX):
    """Case-sensitive: the workbook name starts with the prefix and is not a template."""
    return name.startswith(prefix) & ~name.contains(TEMPLATE_MARKER)


def timesheet_file_filter(listing: DataFrame, name_col: str = "file_name",
                          prefix: str = TIMESHEET_NAME_PREFIX) -> DataFrame:
    """Keep the listing rows whose workbook name passes :func:`timesheet_name_ok`."""
    return listing.where(timesheet_name_ok(F.col(name_col), prefix))


class MissingColumns(ValueError):
    """A required timesheet column is absent in every file of a sector (or of the run)."""


#: Sectors named in a missing-column error, at most.
REPORTED_SECTORS = 20


def _check_required(slim: DataFrame, names: list[str], sector_col: str | None) -> None:
    """Raise :class:`MissingColumns` like the original run would. ``slim`` is the materialised
    per-sheet layout; only sectors with a gap (the first :data:`REPORTED_SECTORS` by name) and one
    row for the whole run come back to the driver."""
    def present(columns):
        return [F.max(F.col(f"_i{names.index(c)}").isNotNull()).alias(c) for c in columns]

    gap = F.lit(False)
    for c in REQUIRED_PER_SECTOR:
        gap = gap | ~F.col(f"`{c}`")
    by = [sector_col] if sector_col else []
    sectors = slim.groupBy(*by).agg(*present(REQUIRED_PER_SECTOR)).where(gap)
    problems = [f"{r[sector_col] if sector_col else 'all'}: {[c for c in REQUIRED_PER_SECTOR if not r[c]]}"
                for r in sectors.orderBy(*by).limit(REPORTED_SECTORS).collect()]
    run = slim.agg(F.count(F.lit(1)).alias("_n"), *present(REQUIRED_ANYWHERE)).first()
    anywhere = [c for c in REQUIRED_ANYWHERE if run["_n"] and not run[c]]
    if anywhere:
        problems.append(f"every sector: {anywhere}")
    if problems:
        raise MissingColumns("; ".join(problems))


def read_timesheet_grids(grid: DataFrame, keys: list[str], name_col: str = "file_name",
                         sector_col: str | None = None, require_columns: bool = False,
                         order_cols: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Raw ``Timesheet`` tabs → timesheet rows, plus a rejects table (one row per sheet).

    Per sheet: range ``A2:I`` (row 1 skipped, nine columns), header = first row of the range,
    names stripped with blanks → ``Unnamed`` and repeats → ``_n``; rows padded or cut to the
    header width. A sheet whose names collide (``X, X_1, X``, or both project names present) is
    rejected instead of read. With ``require_columns`` a sector lacking a column the job reads
    unconditionally raises :class:`MissingColumns` (the original run fails there). ``order_cols`` are
    carried along.
    """
    g = read_range(grid, RANGE)
    gkeys = keys + [sector_col] if sector_col and sector_col not in keys else keys  # sector: constant per sheet
    lay = L.first_row_layout(g, gkeys)
    names = H.dedupe_counter(F.col("header"))
    lay = lay.withColumn("names", names)
    has_both_projects = F.array_contains("names", "Proyecto") & F.array_contains("names", "Nombre de Proyecto")
    lay = lay.withColumn("rejected", H.has_duplicates(F.col("names")) | has_both_projects)
    rejects = lay.where("rejected").select(*keys, "names")
    idx = {}
    for target, aliases in [("Proyecto", PROJECT_ALIASES), ("consecutivo", SEQUENCE_ALIASES)]:
        idx[target] = F.coalesce(*[H.position_of(F.col("names"), F.lit(a)) for a in aliases])
    for c in TIMESHEET_TEXT_COLUMNS:
        if c not in idx:
            idx[c] = H.position_of(F.col("names"), F.lit(c))
    slim = materialize(lay.where(~F.col("rejected")).select(
        *gkeys, "header_idx", "stop_idx", F.size("names").alias("_w"),
        *[e.alias(f"_i{k}") for k, e in enumerate(idx.values())]))
    if require_columns:
        _check_required(slim, list(idx), sector_col)
    rows = L.table_rows(g, slim, gkeys, checkpoint=False)
    fitted = L.fit_cells(F.col("cells"), F.col("_w"))
    cols = [L.cell_at(fitted, F.col(f"_i{k}")).alias(name) for k, name in enumerate(idx.keys())]
    extra = [F.col(sector_col).alias("Sector_Origen")] if sector_col else []
    out = rows.select(*dict.fromkeys([*keys, *(order_cols or [])]), "row_idx", F.col(name_col).alias("archivo_origen"), *extra, *cols)
    return out, rejects


def clean_sector(df: DataFrame, keep_all: bool = False) -> DataFrame:
    """Derive ``nombre``, ``proyecto_id``; strip ``Proyecto``; parse hours and dates; relabel
    ``Mes``; reformat ``Fecha``; drop wholly empty rows (with ``keep_all`` they stay, marked by a false
    ``_kept``).

    All derived columns read the *input* columns (one projection): ``proyecto_id`` comes from the
    unstripped project text, ``Mes`` and ``Fecha`` from the original date text.
    """
    df = T.with_parsed_date(df, "Fecha", "_fecha_tmp")
    df = df.withColumns({
        "nombre": T.last_dash_part(F.col("archivo_origen")),
        "Proyecto": T.strip(_c("Proyecto")),
        "proyecto_id": T.project_id(_c("Proyecto")),
        "Cantidad de horas": T.hours(_c("Cantidad de horas")),
    })
    df = df.withColumns({
        "Mes": F.when(F.col("_fecha_tmp").isNotNull(), T.month_label(F.col("_fecha_tmp"))).otherwise(_c("Mes")),
        "Fecha": T.iso_or_text(F.col("_fecha_tmp"), _c("Fecha")),
    }).drop("_fecha_tmp")
    return df.withColumn("_kept", nonempty_row()) if keep_all else df.where(nonempty_row())


def nonempty_row():
    """Keep a row if hours parsed, or project / description / category is non-blank."""
    def filled(name):
        return _c(name).isNotNull() & (T.strip(_c(name)) != "")
    return (_c("Cantidad de horas").isNotNull() | filled("Proyecto") | filled("Descripción")
            | filled("Category"))


def staff_rates(rates: DataFrame) -> DataFrame:
    """``nombre`` (exact text) and ``Costo interno`` (first ',' → '.', unusable → 0.0)."""
    return rates.select(F.col("Nombre").alias("nombre"),
                        T.rate_timesheet(_c("Costo interno")).alias("Costo interno"))


def cost_rows(ts: DataFrame, rates: DataFrame, mark_copies: bool = False) -> DataFrame:
    """Exact left join on ``nombre`` (duplicate rates fan out); cost = (hours/8) × rate, where an
    unmatched person's rate counts as 0 but the ``Costo interno`` column itself stays null. With
    ``mark_copies`` a row's copies by further rates have ``_copy`` 1, 2, …, the row itself 0."""
    if mark_copies:     # a person has few rates
        order = Window.partitionBy("nombre").orderBy("Costo interno")
        rates = rates.withColumn("_copy", F.row_number().over(order) - 1)
        ts = left_join_small(ts, rates, "nombre").withColumn("_copy", F.coalesce("_copy", F.lit(0)))
        return _costed(ts)
    return _costed(left_join_small(ts, rates, "nombre"))


def _costed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("costo_rate_interno",
                          (_c("Cantidad de horas") / F.lit(8)) * F.coalesce(_c("Costo interno"), F.lit(0.0)))


def alert_flags(df: DataFrame, projects: DataFrame) -> DataFrame:
    """Six row alerts as ints plus their sum (a null flag counts as 0 in the sum).

    ``alerta_proyectos`` is null when the category is null and the project blank (three-valued
    AND); ``alerta_proyecto_nomb`` fires for a non-blank project that is not ``Otro`` and not a
    master project name (inactive projects are valid; master names are compared unstripped).
    """
    cat, proj = _c("Category"), _c("Proyecto")
    df = flag_membership(df, "Proyecto", projects, "Nombre de Proyecto", flag="_known_project")
    flags = {
        "alerta_category": (cat.isNull() | (cat == "")),
        "alerta_subcat": (_c("Sub-Category").isNull() | (_c("Sub-Category") == "")),
        "alerta_proyectos": (cat == PROJECTS_CATEGORY) & (proj.isNull() | (proj == "")),
        "alerta_horas": _c("Cantidad de horas").isNull(),
        "alerta_desc": (_c("Descripción").isNull() | (_c("Descripción") == "")),
        "alerta_proyecto_nomb": (proj.isNotNull() & (proj != "") & (proj != OTHER_PROJECT)
                                 & ~F.col("_known_project")),
    }
    df = df.withColumns({k: v.cast("int") for k, v in flags.items()}).drop("_known_project")
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in ALERT_COLUMNS), F.lit(0))
    return df.withColumn("suma_alertas", total.cast("int"))


#: Tie-breakers after the person in the detail sort: keep one file's rows together and let the
#: range partitioner split a person who holds a large share of all rows across sort tasks.
DETAIL_TIEBREAK = ["archivo_origen", "consecutivo", "Fecha"]


def alert_detail(flagged: DataFrame) -> DataFrame:
    """Rows with at least one alert, sorted by person (then file, row number, date)."""
    return (flagged.where(F.col("suma_alertas") > 0).select(*[_c(c) for c in DETAIL_COLUMNS])
            .orderBy("nombre", *DETAIL_TIEBREAK))


def alert_summary(flagged: DataFrame, review_date: str = REVIEW_DATE) -> DataFrame:
    """Per person: alert counts, the latest ``Fecha`` *as text*, and a stale-date alert when that
    text parses as ``yyyy-MM-dd`` before the review date (unparsable → 0)."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ALERT_COLUMNS]
    # per person and date first: integer sums stay in a hash aggregate, and only the few rows left
    # meet the maximum of a text, which Spark aggregates by sorting
    daily = flagged.groupBy("nombre", "Fecha").agg(*sums)
    g = daily.groupBy("nombre").agg(*sums, F.max("Fecha").alias("max_fecha"))
    stale = T.parse_iso_date(F.col("max_fecha")) < F.to_date(F.lit(review_date))
    g = g.withColumn("alerta_fecha", F.coalesce(stale.cast("int"), F.lit(0)))
    total = sum((F.col(c) for c in ALERT_COLUMNS), F.lit(0).cast("long")) + F.col("alerta_fecha")
    g = g.withColumn("suma_alertas", total.cast("long"))
    return (g.where(F.col("suma_alertas") >= 1).select(*SUMMARY_COLUMNS)
            .orderBy(F.desc("suma_alertas"), F.asc("nombre")))


def consolidated(costed: DataFrame) -> DataFrame:
    """The flat consolidated table in export order."""
    return costed.select(*[_c(c) for c in CONSOLIDATED_COLUMNS])


def audit(timesheet_rows: DataFrame) -> DataFrame:
    """Per sector: rows read and rows kept by the non-empty-row rule (one pass)."""
    hours = T.hours(_c("Cantidad de horas"))
    filled = [_c(n).isNotNull() & (T.strip(_c(n)) != "") for n in ("Proyecto", "Descripción", "Category")]
    keep = hours.isNotNull() | filled[0] | filled[1] | filled[2]
    return timesheet_rows.groupBy("Sector_Origen").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(keep, 1)).alias("n_valid"))


class NoData(ValueError):
    """The run has no timesheet rows, or no usable project master."""


def check_projects(projects: DataFrame) -> None:
    """The project master must name a project; an empty one would flag every named project."""
    if "Nombre de Proyecto" not in projects.columns or projects.limit(1).isEmpty():
        raise NoData("the project master is empty or has no column 'Nombre de Proyecto'")


def flagged_rows(timesheet_rows: DataFrame, rates: DataFrame, projects: DataFrame) -> DataFrame:
    """Clean → cost → flag, written once: every output reads this table instead of re-running cleaning
    and joins. It keeps the empty rows too (``_kept`` false) and tells a row from its copies by
    further rates (``_copy``), so that the audit counts rows read and kept from it, and not from the
    grids again."""
    costed = cost_rows(clean_sector(timesheet_rows, keep_all=True), staff_rates(rates), mark_copies=True)
    return materialize(alert_flags(costed, projects))


def run_audit(every: DataFrame) -> DataFrame:
    """Per sector, from :func:`flagged_rows`: rows read and rows kept by the non-empty-row rule."""
    return every.where("_copy = 0").groupBy("Sector_Origen").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("_kept"), 1)).alias("n_valid"))


def exports(every: DataFrame, consolidated_name: str = "Consolidado", order_cols: list[str] | None = None) -> dict[str, DataFrame]:
    """The three export tables of :func:`flagged_rows`. ``consolidated_name`` names the flat one; with
    ``order_cols`` (file, row) it is in listing order by a range-partitioned sort."""
    flagged = every.where("_kept")
    flat = flagged.orderBy(*order_cols, "_copy") if order_cols else flagged
    return {"Resumen Alertas": alert_summary(flagged), "Detalle Alertas": alert_detail(flagged),
            consolidated_name: consolidated(flat)}


def run(timesheet_rows: DataFrame, rates: DataFrame, projects: DataFrame,
        consolidated_name: str = "Consolidado") -> dict[str, DataFrame]:
    """Whole job: clean → cost → flag; returns the three export tables."""
    return exports(flagged_rows(timesheet_rows, rates, projects), consolidated_name)


def run_from_grids(grid: DataFrame, keys: list[str], rates: DataFrame, projects: DataFrame,
                   name_col: str = "file_name", sector_col: str | None = None, consolidated_name: str = "Consolidado",
                   order_cols: list[str] | None = None) -> dict[str, DataFrame]:
    """Raw ``Timesheet`` tabs (all sectors in one grid) → the three export tables, the rejects
    table and, with a sector column, the per-sector audit. Fails with :class:`MissingColumns`
    when a sector lacks a column the job reads unconditionally, and with :class:`NoData` without a
    project master or without a timesheet row in any folder. ``order_cols``: the columns of ``grid`` that
    give a file's place in the listing; the flat table is then in listing order."""
    check_projects(projects)
    grid = timesheet_file_filter(grid, name_col)
    rows, rejects = read_timesheet_grids(grid, keys, name_col, sector_col, require_columns=True, order_cols=order_cols)
    if rows.limit(1).isEmpty():
        raise NoData("no folder holds a timesheet row")
    every = flagged_rows(rows, rates, projects)
    out = exports(every, consolidated_name, [*order_cols, "row_idx"] if order_cols else None)
    out["Rechazados"] = rejects
    if sector_col:
        out["Auditoria"] = run_audit(every)
    return out
