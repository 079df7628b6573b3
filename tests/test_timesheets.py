"""Timesheet alerts and costs: golden cases and invariants."""

from pyspark.sql import functions as F

from conftest import SF_MID
from sheetfold.plans import budget as BU
from sheetfold.plans import timesheets as TS
from sheetfold.sources.fixtures import fx

COLS = ["archivo_origen", "consecutivo", "Fecha", "Día", "Category", "Sub-Category", "Proyecto", "Descripción",
        "Cantidad de horas", "Mes", "Sector_Origen"]


def ts_rows(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLS))


def projects(spark):
    return spark.createDataFrame([("Interno", "P1", "Si"), ("Interno", "P2", "No")],
                                 "`Tipo de proyecto` string, `Nombre de Proyecto` string, `Activo` string")


def rates(spark):
    return spark.createDataFrame([("Ana", "12,5"), ("Luis", "$3")], "Nombre string, `Costo interno` string")


def test_alert_edge_cases(spark):
    rows = [
        ("Timesheet 2026 - Ana", "1", "2024-01-05", "lun", None, "s", "", "d", "8", "m", "E"),      # cat null, proj blank
        ("Timesheet 2026 - Ana", "2", "2024-01-06", "lun", "Interno", "s", "P2", "  ", "8", "m", "E"),  # blanks-only desc, inactive project
        ("Timesheet 2026 - Ana", "3", "pendiente", "lun", "Proyectos", "s", "", "d", "8", "m", "E"),
        ("Timesheet 2026 - Pedro", "4", "2024-01-05", "lun", "Interno", "s", "P9", "d", "x", "m", "E"),
        ("Timesheet 2026 - Pedro", "5", "", "", "", "", "", "", "", "", "E"),                         # wholly empty
    ]
    clean = TS.clean_sector(ts_rows(spark, rows))
    assert clean.count() == 4
    costed = TS.cost_rows(clean, TS.staff_rates(rates(spark)))
    flagged = TS.alert_flags(costed, projects(spark))
    f = {r["consecutivo"]: r for r in flagged.collect()}
    assert f["1"]["alerta_proyectos"] is None and f["1"]["alerta_category"] == 1 and f["1"]["suma_alertas"] == 1
    assert f["2"]["alerta_desc"] == 0 and f["2"]["alerta_proyecto_nomb"] == 0
    assert f["3"]["alerta_proyectos"] == 1
    assert f["4"]["alerta_proyecto_nomb"] == 1 and f["4"]["alerta_horas"] == 1
    assert f["1"]["costo_rate_interno"] == (8 / 8) * 12.5
    assert f["4"]["Costo interno"] is None and f["4"]["costo_rate_interno"] is None   # hours unknown
    s = {r["nombre"]: r for r in TS.alert_summary(flagged).collect()}
    assert s["Ana"]["max_fecha"] == "pendiente" and s["Ana"]["alerta_fecha"] == 0
    assert s["Pedro"]["alerta_fecha"] == 1
    detail = TS.alert_detail(flagged)
    assert [r["nombre"] for r in detail.collect()] == sorted(r["nombre"] for r in detail.collect())


def test_unmatched_person_costs(spark):
    rows = [("Timesheet 2026 - Nadie", "1", "2024-01-05", "lun", "Interno", "s", "P1", "d", "8", "m", "E")]
    costed = TS.cost_rows(TS.clean_sector(ts_rows(spark, rows)), TS.staff_rates(rates(spark))).first()
    assert costed["costo_rate_interno"] == 0.0 and costed["Costo interno"] is None
    people = spark.createDataFrame([(1, 1, "Nadie", 8.0, "x", "Productividad: 2024-01 X")],
                                   "file_ord int, row_idx int, nombre string, Horas_Presupuestadas double, "
                                   "archivo_origen string, Proyecto string")
    fact = BU.fact_table(people, BU.budget_rates(rates(spark)), ["file_ord", "row_idx"]).first()
    assert fact["Costo_Total_Proyecto"] is None and fact["ID_Presupuesto"] == 1


def test_duplicate_rate_fans_out_with_same_id(spark):
    people = spark.createDataFrame([(1, 1, "Ana", 8.0, "t", "P")],
                                   "file_ord int, row_idx int, nombre string, Horas_Presupuestadas double, "
                                   "archivo_origen string, Proyecto string")
    r = spark.createDataFrame([("ana", "10"), (" ANA ", "20")], "Nombre string, `Costo interno` string")
    fact = BU.fact_table(people, BU.budget_rates(r), ["file_ord", "row_idx"]).collect()
    assert len(fact) == 2 and {x["ID_Presupuesto"] for x in fact} == {1}
    assert sorted(x["Costo_Total_Proyecto"] for x in fact) == [10.0, 20.0]


def test_fixture_branch_counts_and_invariants(spark):
    t = fx(spark, SF_MID, "fx_timesheet")
    assert t.count() == 10_000
    clean = TS.clean_sector(t)
    assert clean.count() == 10_000 - 53
    assert clean.select("nombre").distinct().count() == 136
    flagged = TS.alert_flags(TS.cost_rows(clean, TS.staff_rates(fx(spark, SF_MID, "fx_rates"))),
                             fx(spark, SF_MID, "fx_projects"))
    # detail flags per person add up to the summary's counts (before the date alert)
    per_person = flagged.groupBy("nombre").agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in TS.ALERT_COLUMNS])
    summary = TS.alert_summary(flagged)
    joined = summary.join(per_person.withColumnsRenamed({c: f"d_{c}" for c in TS.ALERT_COLUMNS}), "nombre")
    for c in TS.ALERT_COLUMNS:
        assert joined.where(F.col(c) != F.col(f"d_{c}")).count() == 0
    stale = {r["nombre"]: r["alerta_fecha"] for r in summary.collect()}
    assert sum(stale.values()) == 82


def test_run_returns_three_tables(spark):
    out = TS.run(fx(spark, SF_MID, "fx_timesheet"), fx(spark, SF_MID, "fx_rates"), fx(spark, SF_MID, "fx_projects"))
    assert set(out) == {"Resumen Alertas", "Detalle Alertas", "Consolidado"}
    assert out["Consolidado"].columns == TS.CONSOLIDATED_COLUMNS


def test_run_from_grids(spark):
    from sheetfold.sources.fixtures import lines_to_cells
    grid = lines_to_cells(fx(spark, SF_MID, "fx_grid_timesheet"))
    out = TS.run_from_grids(grid, ["file_name"], fx(spark, SF_MID, "fx_rates"), fx(spark, SF_MID, "fx_projects"),
                            sector_col="sector")
    assert out["Rechazados"].count() == 0
    assert out["Resumen Alertas"].count() == 136
    assert out["Consolidado"].count() > 10_000 - 53


def test_finance_and_budget_run(spark):
    from sheetfold.plans import finance as FI
    from sheetfold.sources.fixtures import lines_to_cells
    fin = FI.run(lines_to_cells(fx(spark, SF_MID, "fx_grid_finance")), ["archivo_origen", "tipo"], "tipo", "archivo_origen")
    n_in, n_out, n_base = (fin[k].count() for k in ("Ingresos", "Gastos", "Base_Looker"))
    assert n_base == n_in + n_out > 0
    audit = fin["Auditoria"].agg(F.sum("n_valid")).first()[0]
    assert audit == n_base
    listed = fx(spark, SF_MID, "fx_budget").select("file_ord", "file_name").distinct()
    bud = BU.run(lines_to_cells(fx(spark, SF_MID, "fx_grid_budget")), ["file_ord"], "file_name", ["file_ord", "row_idx"],
                 fx(spark, SF_MID, "fx_rates"), listed, "file_ord")
    ids = [r[0] for r in bud["Fact_Presupuesto_Horas"].select("ID_Presupuesto").distinct().collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))
    assert bud["Archivos_sin_tabla"].count() == 3


def test_missing_required_column_fails_the_run(spark):
    import pytest
    from conftest import grid_df
    header = ["", "Fecha", "Día", "Category", "Sub-Category", "Proyecto", "Descripción", "Cantidad de horas", "Mes"]
    ok = [["t"], header, ["1", "05/01/2025", "lun", "Interno", "s", "P1", "d", "8", ""]]
    no_hours = [["t"], header[:7] + ["Horas", "Mes"], ["1", "05/01/2025", "lun", "Interno", "s", "P1", "d", "8", ""]]
    g = grid_df(spark, {"Timesheet 2026 - A": ok, "Timesheet 2026 - B": no_hours}, key="file_name",
                extra={"sector": lambda k: "E" if k.endswith("A") else "D"})
    with pytest.raises(TS.MissingColumns, match="D: \\['Cantidad de horas'\\]"):
        TS.read_timesheet_grids(g, ["file_name"], sector_col="sector", require_columns=True)
    rows, _ = TS.read_timesheet_grids(g, ["file_name"], sector_col="sector")
    assert rows.where("file_name like '%B'").first()["Cantidad de horas"] is None
    audit = {r["Sector_Origen"]: (r["n_rows"], r["n_valid"]) for r in TS.audit(rows).collect()}
    assert audit == {"E": (1, 1), "D": (1, 1)}
