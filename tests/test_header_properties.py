"""Header naming: Spark vs the independent DuckDB formulation on many random headers."""

import random

import duckdb
from pyspark.sql import functions as F

from sheetfold import oracle as O
from sheetfold.operators import headers as H
from sheetfold.plans import finance as FI
from sheetfold.plans import timesheets as TS

ALPHABET = ["X", "X_1", "X_2", "", " ", "  X ", "Proyecto", "proyecto x", "2", "Monto con IGV", "MONTO SIN IVA",
            "Monto con Impuestos", "Monto con Impuestos_dup1", "column_1", "column_2", "SItuación", "Situación del pago",
            "Proyecto / Cuenta analítica", "Monto Total / (Monto sin Impuestos)", "Proyecto_dup1", "Unnamed", "A", "A_1"]


def headers(n=300, seed=7):
    rnd = random.Random(seed)
    return [(i, rnd.choice(["Ingreso", "Gasto"]), [rnd.choice(ALPHABET) for _ in range(rnd.randint(1, 9))])
            for i in range(n)]


def duck_rows(hs, expr):
    con = duckdb.connect()
    con.execute("create table h (id integer, tipo varchar, header varchar[])")
    con.executemany("insert into h values (?, ?, ?)", hs)
    return {r[0]: r[1] for r in con.sql(f"select id, {expr} from h").fetchall()}


def test_naming_rules_agree_with_duckdb(spark):
    hs = headers()
    df = spark.createDataFrame(hs, "id int, tipo string, header array<string>")
    checked = H.dedupe_checked(F.col("header"))
    got = {r["id"]: (r["c"], r["k"], r["n"]) for r in df.select(
        "id", checked.alias("c"), FI.canonical(checked, F.col("tipo")).alias("k"),
        H.dedupe_counter(F.col("header")).alias("n")).collect()}
    want_c = duck_rows(hs, O.dedupe_checked("header"))
    want_k = duck_rows(hs, O.canonical(O.dedupe_checked("header"), "tipo"))
    want_n = duck_rows(hs, O.dedupe_counter(O.counter_bases("header")))
    for i, _, _ in hs:
        assert got[i][0] == want_c[i], (i, hs[i])
        assert got[i][1] == want_k[i], (i, hs[i])
        assert got[i][2] == want_n[i], (i, hs[i])
    # every checked / canonical name list is free of duplicates
    assert all(len(set(c)) == len(c) and len(set(k)) == len(k) for c, k, _ in got.values())


def test_colliding_timesheet_headers_are_rejected(spark):
    from conftest import grid_df
    base = ["consecutivo", "Fecha", "Día", "Category", "Sub-Category", "Proyecto", "Descripción", "Cantidad de horas", "Mes"]
    sheets = {
        "ok": [["t"], base, ["1"] * 9],
        "collide": [["t"], ["X", "X_1", "X"] + base[3:], ["1"] * 9],
        "both_projects": [["t"], base[:5] + ["Proyecto", "Nombre de Proyecto"] + base[7:], ["1"] * 9],
    }
    rows, rejects = TS.read_timesheet_grids(grid_df(spark, sheets, key="file_name"), ["file_name"])
    assert sorted(r["file_name"] for r in rejects.collect()) == ["both_projects", "collide"]
    assert [r["file_name"] for r in rows.collect()] == ["ok"]
