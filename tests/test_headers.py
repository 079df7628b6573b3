"""Header naming rules."""

from pyspark.sql import functions as F

from sheetfold.operators import headers as H
from sheetfold.plans import finance as FI


def names(spark, fn, header, *extra):
    df = spark.createDataFrame([(header, *extra)], "h array<string>" + "".join(f", e{i} string" for i in range(len(extra))))
    return df.select(fn(F.col("h"), *[F.col(f"e{i}") for i in range(len(extra))]).alias("n")).first()["n"]


def test_dedupe_checked(spark):
    assert names(spark, H.dedupe_checked, ["X", "X_1", "X", "", "X"]) == ["X", "X_1", "X_2", "column_3", "X_3"]
    assert names(spark, H.dedupe_checked, [" a ", "a", "", "column_2"]) == ["a", "a_1", "column_2", "column_2_1"]


def test_dedupe_counter(spark):
    assert names(spark, H.dedupe_counter, ["", "", "A", "A"]) == ["Unnamed", "Unnamed_1", "A", "A_1"]
    collided = names(spark, H.dedupe_counter, ["X", "X_1", "X"])
    assert collided == ["X", "X_1", "X_1"]
    df = spark.createDataFrame([(collided,)], "n array<string>")
    assert df.select(H.has_duplicates(F.col("n"))).first()[0] is True


def test_canonical_income(spark):
    got = names(spark, FI.canonical,
                ["Proyecto / Cuenta analítica", "Proyecto", "Monto con IGV", "Monto con Impuestos"], "Ingreso")
    assert got == ["Proyecto", "Proyecto_dup1", "Monto con Impuestos", "Monto con Impuestos_dup1"]


def test_canonical_two_depends_on_tab(spark):
    assert names(spark, FI.canonical, ["2"], "Ingreso") == ["Proyecto"]
    assert names(spark, FI.canonical, ["2"], "Gasto") == ["Monto sin Impuestos"]
    assert names(spark, FI.canonical, ["SItuación", "Situación del pago"], "Gasto") == ["Situación", "Situación del pago"]


def test_keyword_lookup(spark):
    h = ["Nombre completo", "Cantidad de horas", "column_2", "Cantidad de horas_1"]
    assert names(spark, lambda c: H.first_matching(c, ["NOMBRE COMPLETO"]), h) == "Nombre completo"
    assert names(spark, lambda c: H.first_matching(c, ["CANTIDAD DE HORAS", "HORAS PRESUPUESTADAS"]), h) == "Cantidad de horas"
    assert names(spark, lambda c: H.first_matching(c, ["COSTO"]), h) is None
