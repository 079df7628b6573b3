"""The three jobs from folders of exported workbooks."""

import csv
import os
import tempfile

from sheetfold.cli import run_cli


def _csv(path, rows):
    from urllib.parse import quote
    head, tail = os.path.split(path)
    if os.path.basename(os.path.dirname(head)) not in ("",):
        # <root>/<folder>/<workbook>/<tab>.csv: names are percent-encoded path segments
        root2, book = os.path.split(head)
        root1, folder = os.path.split(root2)
        if tail.endswith(".csv") and not tail.startswith(("rates", "proyectos")):
            path = os.path.join(root1, quote(folder, safe=""), quote(book, safe=""), quote(tail[:-4], safe="") + ".csv")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f).writerows(rows)


def test_finance_job(spark):
    root = tempfile.mkdtemp(prefix="fin-", dir="/tmp")
    out = tempfile.mkdtemp(prefix="finout-", dir="/tmp")
    inc = [["Reporte"], ["Fecha de emisión del comprobante", "Proyecto / Cuenta analítica", "Situación", "Monto con Impuestos", "USD"],
           ["2025-01-05", "P1", "Real", "S/ 1.000,00", "$ 250,50"], ["2025-01-06", "P1", "Anulado", "S/ 5,00", "$ 1,00"]]
    exp = [["Fecha de factura proveedor", "Proyecto", "SItuación", "MONTO CON IGV", "2"],
           ["2025-02-01", "P2", "Proyectado", "S/ 10,00", "8,47"], ["", "P2", "Real", "S/ 10,00", "8,47"]]
    _csv(os.path.join(root, "Presupuestos", "NUEVO P1", "Proyección - Ingresos.csv"), inc)
    _csv(os.path.join(root, "Presupuestos", "NUEVO P1", "Proyección - Gastos.csv"), exp)
    _csv(os.path.join(root, "Presupuestos", "NUEVO P1 (Copia)", "Proyección - Ingresos.csv"), inc)
    _csv(os.path.join(root, "Presupuestos", "NUEVO P1", "Notas.csv"), [["x"]])
    _csv(os.path.join(root, "Presupuestos", "NUEVO P2 sin gastos", "Proyección - Ingresos.csv"), inc)
    written = run_cli(spark, ["finance", "--input", root, "--out", out, "--format", "csv"])
    assert written == {"Ingresos": 1, "Gastos": 1, "Base_Looker": 2, "Auditoria": 2, "Archivos_con_error": 1}
    from sheetfold.cli import list_books
    assert list_books(spark, [root], 20) == [("Presupuestos", "NUEVO P1", 3), ("Presupuestos", "NUEVO P1 (Copia)", 1),
                                             ("Presupuestos", "NUEVO P2 sin gastos", 1)]
    failed = spark.read.option("header", True).csv(os.path.join(out, "Archivos_con_error")).collect()
    assert [(r["file_name"], r["motivo"]) for r in failed] == [("NUEVO P2 sin gastos", "Proyección - Gastos: missing tab")]
    base = spark.read.option("header", True).csv(os.path.join(out, "Base_Looker")).collect()
    assert sorted((r["Tipo_Movimiento"], r["Fecha"], r["USD"]) for r in base) == [("Gasto", "2025-02-01", None), ("Ingreso", "2025-01-05", "250.5")]
    lines = [r[0] for r in spark.read.text(os.path.join(out, "Base_Looker")).collect()]
    # columns that no sheet has are not exported; null is exported as ''
    assert lines == ["archivo_origen,Tipo_Movimiento,Fecha,Proyecto,Monto sin Impuestos,Monto con Impuestos,USD,"
                     "Fecha de emisión del comprobante,Situación,Fecha de factura proveedor",
                     "NUEVO P1,Ingreso,2025-01-05,P1,,\"S/ 1.000,00\",250.5,2025-01-05,Real,",
                     "NUEVO P1,Gasto,2025-02-01,P2,\"8,47\",\"S/ 10,00\",,,Proyectado,2025-02-01"]

    assert {r["archivo_origen"] for r in base} == {"NUEVO P1"}


def test_budget_and_timesheet_jobs(spark):
    root = tempfile.mkdtemp(prefix="bud-", dir="/tmp")
    out = tempfile.mkdtemp(prefix="budout-", dir="/tmp")
    rates = os.path.join(root, "rates.csv")
    _csv(rates, [["Nombre", "Costo interno"], ["Ana", "$100,0"], ["Luis", "80"]])
    team = [["#REF!"], ["Nombre completo", "Cantidad de horas"], [" Ana ", "16"], ["Insertar nombre", "1"], ["LUIS", "8,5"], ["Total", "9"]]
    _csv(os.path.join(root, "books", "Productividad: 2024-01 X", "Equipo.csv"), team)
    _csv(os.path.join(root, "books", "Productividad: 0005 Y", "Resumen.csv"), [["nada"]])
    written = run_cli(spark, ["budget", "--input", os.path.join(root), "--rates", rates, "--out", out])
    assert written["Fact_Presupuesto_Horas"] == 2
    fact = {r["nombre"]: r for r in spark.read.parquet(os.path.join(out, "Fact_Presupuesto_Horas")).collect()}
    assert fact[" Ana "]["Costo_Total_Proyecto"] == 200.0 and fact["LUIS"]["Costo_Total_Proyecto"] == 85.0
    assert sorted(r["ID_Presupuesto"] for r in fact.values()) == [1, 2]
    assert fact["LUIS"]["proyecto_id"] == "2024_01"

    # as named tables of a catalog folder
    from sheetfold.sources.catalog import Folder
    cat, title = tempfile.mkdtemp(prefix="cat-", dir="/tmp"), f"DWH {os.path.basename(out)}"
    args = ["budget", "--input", root, "--rates", rates, "--out", cat, "--catalog", title]
    assert run_cli(spark, args)["Fact_Presupuesto_Horas"] == 2 and run_cli(spark, args)["Archivos_con_error"] is None
    assert Folder(spark, title).find("Fact_Presupuesto_Horas").count() == 2

    # an unreadable workbook is reported and costs the others nothing
    bad = os.path.join(root, "books", "Productividad%3A%202024-09%20Z", "Equipo.csv")
    os.makedirs(os.path.dirname(bad))
    with open(bad, "wb") as f:
        f.write("Nombre completo,año\n".encode("latin-1"))
    again = run_cli(spark, ["budget", "--input", root, "--rates", rates, "--out", out])
    assert (again["Fact_Presupuesto_Horas"], again["Archivos_con_error"]) == (2, 1)
    assert [(r["file_name"], r["motivo"]) for r in spark.read.parquet(os.path.join(out, "Archivos_con_error")).collect()] == \
        [("Productividad: 2024-09 Z", "Equipo: not UTF-8 text")]

    # a fixed list of workbooks: only those, numbered in list order
    team2 = [["Nombre completo", "Cantidad de horas"], ["EVA", "4"]]
    _csv(os.path.join(root, "books", "Productividad: 2024-02 Z", "Equipo.csv"), team2)
    out2 = tempfile.mkdtemp(prefix="budout2-", dir="/tmp")
    run_cli(spark, ["budget", "--input", root, "--rates", rates, "--out", out2,
                    "--workbook", "Productividad: 2024-02 Z", "--workbook", "Productividad: 2024-01 X"])
    ids = {r["nombre"]: r["ID_Presupuesto"] for r in spark.read.parquet(os.path.join(out2, "Fact_Presupuesto_Horas")).collect()}
    assert ids == {"EVA": 1, " Ana ": 2, "LUIS": 3}

    ts_root = tempfile.mkdtemp(prefix="ts-", dir="/tmp")
    projects = os.path.join(ts_root, "proyectos.csv")
    _csv(projects, [["Tipo de proyecto", "Nombre de Proyecto", "Activo"], ["Interno", "2024-01 - X", "Si"]])
    sheet = [["título"], ["", "Fecha", "Día", "Category", "Sub-Category", "Nombre de Proyecto", "Descripción", "Cantidad de horas", "Mes", "Notas"],
             ["1", "05/01/2025", "lun", "Proyectos", "s", "2024-01 - X", "trabajo", "8", "", "n"],
             ["2", "pendiente", "mar", "", "", "", "reunión", "", "", ""]]
    _csv(os.path.join(ts_root, "dev", "Timesheet 2026 - Ana", "Timesheet.csv"), sheet)
    _csv(os.path.join(ts_root, "dev", "Timesheet 2026 - Plantilla", "Timesheet.csv"), sheet)
    ts_out = tempfile.mkdtemp(prefix="tsout-", dir="/tmp")
    written = run_cli(spark, ["timesheets", "--input", ts_root, "--sector", "dev=Desarrollo", "--rates", rates,
                              "--projects", projects, "--out", ts_out])
    assert written["Rechazados"] is None and written["Consolidado"] == 2
    assert written["Auditoria"] == 1
    cons = spark.read.parquet(os.path.join(ts_out, "Consolidado")).collect()
    assert len(cons) == 2 and {r["Sector_Origen"] for r in cons} == {"Desarrollo"}
    row = [r for r in cons if r["consecutivo"] == "1"][0]
    assert (row["Fecha"], row["Mes"], row["costo_rate_interno"], row["Proyecto"]) == ("2025-01-05", "ene/2025", 0.0, "2024-01 - X")
    summary = spark.read.parquet(os.path.join(ts_out, "Resumen Alertas")).collect()
    assert summary[0]["nombre"] == "Ana" and summary[0]["max_fecha"] == "pendiente"


def test_parquet_grids(spark):
    from sheetfold.sources.fixtures import fx, lines_to_cells
    from conftest import SF_SMALL
    from pyspark.sql import functions as F
    root = tempfile.mkdtemp(prefix="pgrid-", dir="/tmp")
    g = lines_to_cells(fx(spark, SF_SMALL, "fx_grid_finance"))
    g = g.select(F.lit("fin").alias("folder"), F.col("archivo_origen").alias("file_id"),
                 F.col("archivo_origen").alias("file_name"),
                 F.when(F.col("tipo") == "Ingreso", "Proyección - Ingresos").otherwise("Proyección - Gastos").alias("tab"),
                 "row_idx", "cells")
    # the same workbooks listed again in a second folder: read once (the last listed copy)
    g = g.unionByName(g.withColumn("folder", F.lit("fin_copy")))
    g.write.parquet(os.path.join(root, "grid.parquet"))
    out = tempfile.mkdtemp(prefix="pgridout-", dir="/tmp")
    written = run_cli(spark, ["finance", "--input", os.path.join(root, "grid.parquet"), "--grid-format", "parquet", "--out", out])
    import __spark_entry__ as E
    assert written["Base_Looker"] == E.queries()["fin_master_order"](spark, SF_SMALL).count()


def test_size_partitions_from_listed_bytes(spark):
    from sheetfold.cli import size_partitions
    root = tempfile.mkdtemp(prefix="sized-", dir="/tmp")
    _csv(os.path.join(root, "f", "NUEVO A", "Proyección - Ingresos.csv"), [["x"] * 10] * 100)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        size_partitions(spark, [root])
        cores = spark.sparkContext.defaultParallelism
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(cores)       # tiny input: one wave
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(128 * 1024 * 1024)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_no_matching_tabs_writes_nothing(spark):
    root = tempfile.mkdtemp(prefix="notabs-", dir="/tmp")
    _csv(os.path.join(root, "f", "NUEVO x", "Otra.csv"), [["a", "b"]])
    out = tempfile.mkdtemp(prefix="notabs-out-", dir="/tmp")
    written = run_cli(spark, ["finance", "--input", root, "--out", out])
    assert written == {"Ingresos": None, "Gastos": None, "Base_Looker": None, "Auditoria": None, "Archivos_con_error": 1}
    empty = tempfile.mkdtemp(prefix="noworkbooks-", dir="/tmp")
    assert run_cli(spark, ["finance", "--input", empty, "--out", out])["Base_Looker"] is None
