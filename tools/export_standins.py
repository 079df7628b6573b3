"""Write the stand-in grids as folders of exported workbooks (one CSV per tab), the layout the
CLI reads: ``<out>/<job>/<folder>/<workbook>/<tab>.csv`` (names percent-encoded), plus the
rates and project-master tabs as CSV tables with a header.

    python tools/export_standins.py /root/testdata/sf0.01 OUT_DIR

Each tab's rows are written by the task that holds them (rows are partitioned by tab and sorted
by position), so nothing passes through the driver.
"""

from __future__ import annotations

import csv
import os
import sys
from urllib.parse import quote

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sheetfold.plans import finance as FI  # noqa: E402
from sheetfold.sources.fixtures import fx, lines_to_cells  # noqa: E402


def _write_tabs(df: DataFrame, root: str) -> None:
    """``df``: folder, workbook, tab, row_idx, cells → one CSV per (folder, workbook, tab)."""
    def write_partition(rows):
        handle, current = None, None
        for r in rows:
            key = (r["folder"], r["workbook"], r["tab"])
            if key != current:
                if handle:
                    handle.close()
                d = os.path.join(root, quote(r["folder"], safe=""), quote(r["workbook"], safe=""))
                os.makedirs(d, exist_ok=True)
                handle = open(os.path.join(d, quote(r["tab"], safe="") + ".csv"), "w", newline="", encoding="utf-8")
                writer, current = csv.writer(handle), key
            writer.writerow(list(r["cells"]))
        if handle:
            handle.close()

    (df.repartition("folder", "workbook", "tab").sortWithinPartitions("folder", "workbook", "tab", "row_idx")
     .foreachPartition(write_partition))


def export(spark: SparkSession, sf: str, out: str) -> dict[str, str]:
    fin = lines_to_cells(fx(spark, sf, "fx_grid_finance")).select(
        F.lit("Presupuestos").alias("folder"), F.col("archivo_origen").alias("workbook"),
        F.when(F.col("tipo") == FI.INCOME, F.lit(FI.INCOME_TAB)).otherwise(F.lit(FI.EXPENSE_TAB)).alias("tab"),
        "row_idx", "cells")
    _write_tabs(fin, os.path.join(out, "finance"))
    bud = lines_to_cells(fx(spark, sf, "fx_grid_budget")).select(
        F.lit("books").alias("folder"), F.col("file_name").alias("workbook"), F.lit("Equipo").alias("tab"), "row_idx", "cells")
    _write_tabs(bud, os.path.join(out, "budget"))
    ts = lines_to_cells(fx(spark, sf, "fx_grid_timesheet")).select(
        F.col("sector").alias("folder"), F.col("file_name").alias("workbook"), F.lit("Timesheet").alias("tab"), "row_idx", "cells")
    _write_tabs(ts, os.path.join(out, "timesheets"))
    paths = {"rates": os.path.join(out, "rates.csv"), "projects": os.path.join(out, "proyectos.csv")}
    for name, view in [("rates", "fx_rates"), ("projects", "fx_projects")]:
        (fx(spark, sf, view).coalesce(1).write.mode("overwrite").option("header", True).option("emptyValue", "")
         .option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(paths[name]))
    return paths


if __name__ == "__main__":
    from sheetfold.session import build_session
    session = build_session("local[8]")
    print(export(session, sys.argv[1], sys.argv[2]))
    session.stop()
