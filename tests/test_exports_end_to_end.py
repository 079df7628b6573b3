"""The CLI on exported stand-ins gives exactly what the registered queries give."""

import os
import sys
import tempfile
from collections import Counter

import __spark_entry__ as E
from conftest import SF_SMALL
from sheetfold.cli import run_cli
from sheetfold.sources.fixtures import fx

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from export_standins import export  # noqa: E402


def rows(df):
    cols = sorted(df.columns)
    return Counter(tuple(r[c] for c in cols) for r in df.select(*cols).collect())


def test_cli_on_exports_matches_queries(spark):
    root = tempfile.mkdtemp(prefix="exports-", dir="/tmp")
    paths = export(spark, SF_SMALL, root)
    q = E.queries()

    out = tempfile.mkdtemp(prefix="exp-fin-", dir="/tmp")
    run_cli(spark, ["finance", "--input", os.path.join(root, "finance"), "--out", out])
    assert rows(spark.read.parquet(os.path.join(out, "Base_Looker"))) == rows(q["fin_present_columns"](spark, SF_SMALL))

    # the same exports ingested as a Parquet grid give the same finance masters
    grid_path = os.path.join(tempfile.mkdtemp(prefix="exp-grid-", dir="/tmp"), "grid.parquet")
    run_cli(spark, ["ingest", "--input", os.path.join(root, "finance"), "--out", grid_path])
    out2 = tempfile.mkdtemp(prefix="exp-fin2-", dir="/tmp")
    run_cli(spark, ["finance", "--input", grid_path, "--grid-format", "parquet", "--out", out2])
    assert rows(spark.read.parquet(os.path.join(out2, "Base_Looker"))) == rows(spark.read.parquet(os.path.join(out, "Base_Looker")))

    titles = [r["file_name"] for r in
              fx(spark, SF_SMALL, "fx_budget").select("file_ord", "file_name").distinct().orderBy("file_ord").collect()]
    out = tempfile.mkdtemp(prefix="exp-bud-", dir="/tmp")
    args = ["budget", "--input", os.path.join(root, "budget"), "--rates", paths["rates"], "--out", out]
    for t in titles:
        args += ["--workbook", t]
    run_cli(spark, args)
    assert rows(spark.read.parquet(os.path.join(out, "Fact_Presupuesto_Horas"))) == rows(q["budget_fact"](spark, SF_SMALL))

    out = tempfile.mkdtemp(prefix="exp-ts-", dir="/tmp")
    run_cli(spark, ["timesheets", "--input", os.path.join(root, "timesheets"), "--rates", paths["rates"],
                    "--projects", paths["projects"], "--out", out])
    assert rows(spark.read.parquet(os.path.join(out, "Consolidado"))) == \
        rows(q["ts_grid_consolidated"](spark, SF_SMALL))
    assert rows(spark.read.parquet(os.path.join(out, "Resumen Alertas"))) == rows(q["ts_grid_alert_summary"](spark, SF_SMALL))
