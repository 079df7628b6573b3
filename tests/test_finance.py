"""Finance cleaner on hand-written tabs."""

from conftest import grid_df
from sheetfold.plans import finance as FI


def clean(spark, sheets, tipo):
    g = grid_df(spark, sheets, extra={"tipo": lambda k: tipo, "archivo_origen": lambda k: f"NUEVO {k}"})
    return FI.clean_grids(g, ["sheet"], "tipo", "archivo_origen")


def test_expense_without_date_column_loses_rows(spark):
    out = clean(spark, {"e": [["Proyecto", "SItuación", "USD"], ["P", "Real", "$ 10,00"]]}, "Gasto")
    assert out.where("_valid").count() == 0
    assert out.where("_real").count() == 1


def test_income_without_date_column_keeps_rows(spark):
    out = clean(spark, {"i": [["Proyecto", "Situación", "USD"], ["P", " real ", "$ 1.234,56"]]}, "Ingreso")
    rows = out.where("_valid").collect()
    assert len(rows) == 1 and rows[0]["Fecha"] == "" and rows[0]["USD"] == 1234.56


def test_tab_without_usd_skips_usd_filter(spark):
    out = clean(spark, {"i": [["Proyecto", "Situación"], ["P", "Proyectado"]]}, "Ingreso")
    rows = out.where("_valid").collect()
    assert len(rows) == 1 and rows[0]["USD"] is None


def test_filters(spark):
    sheet = [["Fecha de factura proveedor", "Proyecto", "SItuación", "MONTO CON IGV", "USD"],
             ["2024-01-05", "P", "Real", "S/ 10,00", "$ 5,00"],      # valid
             ["2024-01-05", "P", "Anulado", "S/ 10,00", "$ 5,00"],   # status
             ["2024-01-05", "P", "Real", "S/ 10,00", "-5,00"],       # sign lost → 5.0, valid
             ["2024-01-05", "P", "Real", "S/ 10,00", "0,00"],        # zero USD
             ["2024-01-05", "P", "Real", "0,00", "$ 5,00"],          # zero gross
             [" ", "P", "Real", "S/ 10,00", "$ 5,00"],               # expense without date
             ["", "", "", "", "$ 5,00"]]                              # ghost row
    out = clean(spark, {"e": sheet}, "Gasto")
    assert out.where("_real").count() == 6
    valid = sorted(r["row_idx"] for r in out.where("_valid").collect())
    assert valid == [1, 3]
    m = FI.masters(out)
    assert m["Gastos"].count() == 2 and m["Ingresos"].count() == 0 and m["Base_Looker"].count() == 2
    assert m["Base_Looker"].columns == FI.MASTER_ORDER


def test_name_filter(spark):
    lst = spark.createDataFrame([("nuevo a",), ("NUEVO b (Copia)",), ("Nuevo c",), ("viejo",)], "file_name string")
    assert sorted(r[0] for r in FI.finance_file_filter(lst).collect()) == ["Nuevo c", "nuevo a"]
