"""Command line: run the three jobs on folders of exported workbooks.

    python -m sheetfold finance    --input ROOT [--input ROOT ...] --out DIR
    python -m sheetfold budget     --input ROOT --rates RATES.csv [--workbook TITLE ...] --out DIR
    python -m sheetfold timesheets --input ROOT --sector FOLDER=LABEL ... --rates RATES.csv
                                   --projects PROJECTS.csv --out DIR
    python -m sheetfold list       --input ROOT [--limit 20]
    python -m sheetfold ingest     --input ROOT --out GRID.parquet   (CSV exports → Parquet grid)

Workbooks are read from ``ROOT/<folder>/<workbook>/<tab>.csv`` (names percent-encoded as path
segments, so titles may hold ``:``) or from ``ROOT/folder=/workbook=/tab=/part-*``; rates and project master are
tabs exported with their header row. Each output table is written to ``DIR/<table>`` (Parquet,
or CSV with ``--format csv``: header first, null as '', dates as text); an empty result leaves
the previous output in place.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetfold.operators.joins import materialize, missing_from, sized_side
from sheetfold.operators.rowid import dense_index
from sheetfold.plans import budget as BU
from sheetfold.plans import finance as FI
from sheetfold.plans import timesheets as TS
from sheetfold.session import build_session, scale_conf
from sheetfold.sources import grid as G
from sheetfold.sources import listing as LS
from sheetfold.sources.catalog import Folder
from sheetfold.sources.sinks import check_destination, write_table


def _write(outputs: dict[str, DataFrame], out_dir: str, fmt: str, protected: list[str],
           skip_empty: bool = True) -> dict[str, int | None]:
    return {name: write_table(df, os.path.join(out_dir, name), fmt=fmt, protected=protected, skip_empty=skip_empty)
            for name, df in outputs.items()}


def _save(outputs: dict[str, DataFrame], folder: Folder, skip_empty: bool = True) -> dict[str, int | None]:
    """The outputs as named tables of a catalog folder, found by name or created."""
    saved = {name: folder.save(df, name, skip_empty=skip_empty) for name, df in outputs.items()}
    return {name: None if did == "skipped" else rows for name, (did, rows) in saved.items()}


def _tab_listing(spark, inputs: list[str], grid_format: str, tabs: list[str] | None = None) -> DataFrame:
    """Every workbook tab under the inputs: ``folder, file_id, file_name, tab``. CSV exports are
    listed from file metadata only; Parquet grids by their key columns."""
    if grid_format == "csv":
        listing = G.list_workbook_exports(spark, inputs).drop("path").distinct()
    else:
        listing = None
        for path in inputs:
            t = G.read_parquet_grid(spark, path).select("folder", "file_id", "file_name", "tab").distinct()
            listing = t if listing is None else listing.unionByName(t)
        listing = listing.distinct()
    return listing.where(F.col("tab").isin(*tabs)) if tabs else listing


def load_scan(spark, inputs: list[str], tabs: list[str], grid_format: str = "csv", max_cols: int | None = None,
              title_filter=None) -> tuple[DataFrame, DataFrame]:
    """The ``tabs`` of the workbooks under the inputs whose title passes ``title_filter``, and the workbooks
    with a tab that cannot be read (``file_id, file_name, motivo``; none of their rows is in the grid).
    For CSV exports tabs and titles prune files before they are opened (predicates on file metadata);
    for Parquet grids the tab predicate reaches the scan. ``max_cols`` is the job's own range (26
    for ``A:Z``); without it rows are whole."""
    if grid_format == "csv":
        scan = G.scan_workbook_exports(spark, inputs, max_cols=max_cols, tabs=tabs, title_filter=title_filter)
        failed = scan.failures.groupBy("file_id", "file_name").agg(
            F.array_join(F.array_sort(F.collect_set(F.concat_ws(": ", "tab", "reason"))), "; ").alias("motivo"))
        failed = materialize(failed)
        return scan.grid.join(sized_side(failed.select("file_id")), "file_id", "left_anti"), failed
    grid = None
    for path in inputs:
        g = G.read_parquet_grid(spark, path).select("folder", "file_id", "file_name", "tab", "row_idx", "cells")
        grid = g if grid is None else grid.unionByName(g)
    grid = grid.where(F.col("tab").isin(*tabs))
    if title_filter is not None:
        grid = grid.where(title_filter(F.col("file_name")))
    none = spark.createDataFrame([], "file_id string, file_name string, motivo string")
    return grid.withColumn("cells", F.slice("cells", 1, max_cols)) if max_cols else grid, none


def finance(spark, inputs: list[str], grid_format: str = "csv") -> dict[str, DataFrame]:
    """Listing first (file metadata): de-duplicate workbooks by id (the last listed copy wins),
    keep names starting with NUEVO that are not copies, report those missing a projection tab or
    with one that cannot be read. Only the projection tabs of name-matching workbooks are opened;
    duplicates and failed workbooks are dropped by size-checked joins. Exports are in listing order."""
    all_tabs = _tab_listing(spark, inputs, grid_format)
    books = dense_index(all_tabs.select("folder", "file_id", "file_name").distinct(), ["folder", "file_name"], "file_ord")
    kept = materialize(FI.finance_file_filter(LS.dedupe_by_id(books, "file_id", "file_ord"), "file_name"))
    kept = kept.select("file_id", "folder", "file_ord")
    tabs = all_tabs.join(sized_side(kept), ["file_id", "folder"], "left_semi")
    has = tabs.groupBy("file_id", "file_name").agg(
        F.max((F.col("tab") == FI.INCOME_TAB).cast("int")).alias("_in"),
        F.max((F.col("tab") == FI.EXPENSE_TAB).cast("int")).alias("_out"))
    lacking = has.where((F.col("_in") == 0) | (F.col("_out") == 0)).select(
        "file_id", "file_name", F.concat_ws(": ", F.when(F.col("_in") == 0, F.lit(FI.INCOME_TAB)).otherwise(F.lit(FI.EXPENSE_TAB)),
                                            F.lit("missing tab")).alias("motivo"))
    grid, broken = load_scan(spark, inputs, [FI.INCOME_TAB, FI.EXPENSE_TAB], grid_format, max_cols=FI.RANGE_COLUMNS,
                             title_filter=FI.finance_name_ok)
    broken = broken.join(sized_side(kept.select("file_id")), "file_id", "left_semi")
    failed = materialize(lacking.unionByName(broken).groupBy("file_id", "file_name").agg(
        F.array_join(F.array_sort(F.collect_set("motivo")), "; ").alias("motivo")))
    grid = (grid.join(sized_side(kept), ["file_id", "folder"])
            .join(sized_side(failed.select("file_id")), "file_id", "left_anti"))
    grid = grid.withColumn("tipo", F.when(F.col("tab") == FI.INCOME_TAB, F.lit(FI.INCOME)).otherwise(F.lit(FI.EXPENSE)))
    out = FI.run(grid, ["file_id", "tab"], "tipo", "file_name", "file_ord")
    out["Archivos_con_error"] = failed
    return out


def budget(spark, inputs: list[str], rates_path: str | None, workbooks: list[str] | None = None,
           grid_format: str = "csv") -> dict[str, DataFrame]:
    """The team tab of every workbook (or only the ``workbooks`` titles, numbered in that order;
    else folder-then-title order), then the budget fact and the report of listed workbooks that
    gave no table."""
    books = _tab_listing(spark, inputs, grid_format).select("folder", "file_id", "file_name").distinct()
    title_filter = None
    if workbooks:
        order = spark.createDataFrame(list(enumerate(workbooks, start=1)), "file_ord int, file_name string")
        books = books.join(F.broadcast(order), "file_name")      # the list comes from the command line

        def title_filter(t):  # prunes the files of other workbooks
            return t.isin(*workbooks)
    else:
        books = dense_index(books, ["folder", "file_name", "file_id"], "file_ord")
    grid, failed = load_scan(spark, inputs, [BU.TEAM_TAB], grid_format, title_filter=title_filter)
    grid = grid.join(sized_side(books.select("file_id", "file_ord")), "file_id")
    rates = G.read_table_export(spark, rates_path) if rates_path else None
    out = BU.run(grid, ["file_id"], "file_name", ["file_ord", "row_idx"], rates,
                 books.select("file_id", "file_name"), "file_id")
    out["Archivos_con_error"] = failed
    return out


def timesheets(spark, inputs: list[str], sectors: dict[str, str], rates_path: str, projects_path: str,
               grid_format: str = "csv") -> dict[str, DataFrame]:
    """Only ``Timesheet`` tabs of workbooks whose names pass the case-sensitive filter are
    opened; the folder gives the sector. Workbooks with such a name and no row in that tab are reported."""
    books = _tab_listing(spark, inputs, grid_format).where(TS.timesheet_name_ok(F.col("file_name")))
    books = books.select("folder", "file_id", "file_name").distinct()
    # listing order: the sectors as given, then folders by name, the files of a folder by name
    listed = LS.ordered_listing(books, list(sectors))
    grid, failed = load_scan(spark, inputs, ["Timesheet"], grid_format, title_filter=TS.timesheet_name_ok)
    grid = grid.join(sized_side(listed.select("file_id", "file_ord"), checkpoint=True), "file_id")
    mapping = F.create_map(*[F.lit(x) for kv in sectors.items() for x in kv]) if sectors else None
    sector = F.coalesce(F.try_element_at(mapping, F.col("folder")), F.col("folder")) if mapping is not None else F.col("folder")
    grid = grid.withColumn("sector", sector)      # unmapped folders keep their own name
    out = TS.run_from_grids(grid, ["file_id"], G.read_table_export(spark, rates_path),
                            G.read_table_export(spark, projects_path), name_col="file_name", sector_col="sector",
                            order_cols=["file_ord"])
    out["Archivos_con_error"] = failed
    out["Archivos_sin_tabla"] = missing_from(books, grid, "file_id")
    return out


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="sheetfold")
    ap.add_argument("job", choices=["finance", "budget", "timesheets", "list", "ingest"])
    ap.add_argument("--input", action="append", required=True, help="root folder of exported workbooks")
    ap.add_argument("--out", help="output folder (jobs)")
    ap.add_argument("--limit", type=int, default=20, help="list: how many workbooks to show")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="output format")
    ap.add_argument("--grid-format", default="csv", choices=["csv", "parquet"],
                    help="inputs are CSV exports or Parquet grid tables")
    ap.add_argument("--rates", help="rates tab exported with its header (Nombre, Costo interno)")
    ap.add_argument("--projects", help="timesheets: project master exported with its header")
    ap.add_argument("--sector", action="append", default=[], help="FOLDER=LABEL (timesheets)")
    ap.add_argument("--workbook", action="append", default=[],
                    help="budget: only these workbook titles, numbered in this order")
    ap.add_argument("--replace-empty", action="store_true",
                    help="write empty results too (default: an empty result keeps the previous output)")
    ap.add_argument("--catalog", metavar="FOLDER", help="save the outputs as named tables of this catalog folder; "
                    "--out is where a new folder's files go")
    ap.add_argument("--master", default=None)
    return ap


def list_books(spark, inputs: list[str], limit: int) -> list[tuple[str, str, int]]:
    """First ``limit`` workbooks (folder, title, number of tabs) in listing order — a quick check
    that the export folders are reachable; only file metadata is read."""
    tabs = G.list_workbook_exports(spark, inputs)
    books = tabs.groupBy("folder", "file_name").agg(F.count(F.lit(1)).alias("tabs"))
    return [(r["folder"], r["file_name"], r["tabs"]) for r in books.orderBy("folder", "file_name").limit(limit).collect()]


def ingest(spark, inputs: list[str], out: str) -> int | None:
    """CSV workbook exports → one Parquet grid table (``folder, file_id, file_name, tab,
    row_idx, cells``), clustered by workbook, tab and position so row-group statistics help
    later tab / workbook predicates. Returns the rows written."""
    grid = G.read_workbook_exports(spark, inputs)
    grid = grid.repartitionByRange("file_id", "tab", "row_idx").sortWithinPartitions("file_id", "tab", "row_idx")
    return write_table(grid, out, fmt="parquet", protected=inputs)


def run_cli(spark, argv: list[str]) -> dict[str, int | None]:
    """Run one job with an existing session; returns {table: rows written, None if skipped}."""
    ap = parser()
    a = ap.parse_args(argv)
    if a.job == "ingest":
        if not a.out:
            ap.error("--out is required")
        return {"grid": ingest(spark, a.input, a.out)}
    if a.job == "list":
        for folder, title, n in list_books(spark, a.input, a.limit):
            print(f"{folder} | {title} | {n} tabs")
        return {}
    if not a.out:
        ap.error("--out is required")
    if a.job == "finance":
        outputs = finance(spark, a.input, a.grid_format)
    elif a.job == "budget":
        outputs = budget(spark, a.input, a.rates, a.workbook, a.grid_format)
    else:
        if not (a.rates and a.projects):
            ap.error("timesheets needs --rates and --projects")
        outputs = timesheets(spark, a.input, dict(s.split("=", 1) for s in a.sector), a.rates, a.projects,
                             a.grid_format)
    if a.catalog:
        check_destination(spark, a.out, a.input)
        return _save(outputs, Folder(spark, a.catalog, a.out), skip_empty=not a.replace_empty)
    return _write(outputs, a.out, a.format, protected=a.input,
                  skip_empty=not a.replace_empty)


def size_partitions(spark, inputs: list[str]) -> None:
    """Set shuffle/split sizes from the bytes actually listed under the inputs (file metadata
    only, no content is read)."""
    total = 0
    for root in inputs:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        total += listed.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    cores = spark.sparkContext.defaultParallelism
    for k, v in scale_conf(total, cores).items():
        spark.conf.set(k, v)


def main(argv: list[str] | None = None) -> None:
    a = parser().parse_args(argv)
    spark = build_session(a.master, app=f"sheetfold-{a.job}")
    try:
        if a.job != "list":
            size_partitions(spark, a.input)
        for name, n in run_cli(spark, argv).items():
            print(f"{name}: {n} rows" if n is not None else f"{name}: empty, previous output kept")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
