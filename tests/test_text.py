"""Scalar functions: golden cases (FIXTURES.md §4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sheetfold.functions import text as T


def one(spark, col_fn, value):
    df = spark.createDataFrame([(value,)], "v string")
    return df.select(col_fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("text,expected", [
    ("$ 1.234,56", 1234.56), ("1,234.56", 1.23456), ("-500", 500.0), ("1,234,567", None),
    ("0,00", 0.0), ("", None), ("n/a", None), ("S/ 112.946,26", 112946.26),
])
def test_amount_eu(spark, text, expected):
    assert one(spark, T.amount_eu, text) == expected


@pytest.mark.parametrize("text,expected", [("$12,5", 12.5), ("1.234,56", None), ("7", 7.0), ("", None)])
def test_rate_budget(spark, text, expected):
    assert one(spark, T.rate_budget, text) == expected


@pytest.mark.parametrize("text,expected", [("$12,5", 0.0), ("", 0.0), (None, 0.0), ("12,5", 12.5)])
def test_rate_timesheet(spark, text, expected):
    assert one(spark, T.rate_timesheet, text) == expected


@pytest.mark.parametrize("text,expected", [("8,5", 8.5), ("x", None), ("", None), ("n/a", None),
                                           (" 8 ", None), ("8d", None), ("nan", None), ("1e2", 100.0)])
def test_hours_and_numeric_shape(spark, text, expected):
    assert one(spark, T.hours, text) == expected


@pytest.mark.parametrize("text,expected", [
    ("05/01/2025", dt.date(2025, 1, 5)), ("01/13/2025", dt.date(2025, 1, 13)), ("5.1.2025", dt.date(2025, 1, 5)),
    ("2025-1-5", dt.date(2025, 1, 5)), ("31/02/2025", None), ("2024-01-05 10:00:00", dt.date(2024, 1, 5)),
    (" 05.01.2024", dt.date(2024, 1, 5)), ("05/01/25", dt.date(2025, 1, 5)), ("05-01-2024", dt.date(2024, 1, 5)),
    ("pendiente", None), ("", None), ("2024 - 01 - 05", dt.date(2024, 1, 5)),
    ("05/01/75", dt.date(1975, 1, 5)), ("05/01/68", dt.date(2068, 1, 5)), ("05/01/69", dt.date(1969, 1, 5)),
    ("29/02/72", dt.date(1972, 2, 29)),
])
def test_parse_date_multi(spark, text, expected):
    assert one(spark, T.parse_date_multi, text) == expected
    df = spark.createDataFrame([(text,)], "v string")
    assert T.with_parsed_date(df, "v", "d").first()["d"] == expected


def test_impossible_date_keeps_text(spark):
    d = T.parse_date_multi(F.col("v"))
    df = spark.createDataFrame([("31/02/2025",), ("5/1/2025",)], "v string")
    got = [r["f"] for r in df.select(T.iso_or_text(d, F.col("v")).alias("f")).collect()]
    assert got == ["31/02/2025", "2025-01-05"]


def test_month_label(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 5),), (dt.date(2024, 12, 31),)], "d date")
    assert [r[0] for r in df.select(T.month_label(F.col("d"))).collect()] == ["ene/2025", "dic/2024"]


@pytest.mark.parametrize("text,expected", [("2024-01 - X", "2024_01"), ("123-Foo", "123_"), (" 2024-01", None),
                                           ("abc", None), (None, None)])
def test_project_id(spark, text, expected):
    assert one(spark, T.project_id, text) == expected


def test_quote_guard(spark):
    from sheetfold.plans.budget import budget_project_id, project_from_title
    title = "Productividad: 0005 N"
    assert one(spark, project_from_title, title) == "0005 N"
    assert one(spark, lambda c: budget_project_id(project_from_title(c)), title) == "'0005"
    assert one(spark, lambda c: budget_project_id(project_from_title(c)), "Productividad: 2024-01 X") == "2024_01"


@pytest.mark.parametrize("text,expected", [("Timesheet 2026 - Ana-María ", "María"), ("Timesheet 2026 - Luis", "Luis"),
                                           ("Timesheet 2026 - X-B ", "B")])
def test_person_name(spark, text, expected):
    assert one(spark, T.last_dash_part, text) == expected


def test_strip_unicode(spark):
    assert one(spark, T.strip, " \t ab c　\n") == "ab c"


def test_replace_first(spark):
    assert one(spark, lambda c: T.replace_first(c, ",", "."), "1,2,3") == "1.2,3"
    assert one(spark, lambda c: T.replace_first(c, ",", "."), "123") == "123"


def test_shape_guard_never_changes_results(spark):
    tricky = ["5/1/-25", "5/1/+25", "5/1/25", "5-1--2024", "5.1.-2024", "-2024-1-510:00:00", "5/1/-2024",
              "05/01/0025", "+2024-1-5", "-2024-1-5", "12345-1-5", "2024-001-5", "005/1/2025", "٢٠٢٤-1-5",
              "2024-1-5+10:00:00", "31/02/2025", "2024 - 1 - 5", " 5 . 1 . 2024 ", "1/13/2025", "pendiente", "", None]
    df = spark.createDataFrame([(v,) for v in tricky], "v string")
    sq = T.squeeze_whitespace(F.col("v"))
    plain = F.coalesce(*[T._attempt(sq, f) for f in T.DATE_FORMATS])
    rows = df.select("v", T.parse_date_multi(F.col("v")).cast("string").alias("guarded"),
                     plain.cast("string").alias("plain")).collect()
    assert [(r["v"], r["guarded"]) for r in rows] == [(r["v"], r["plain"]) for r in rows]
    assert sum(r["plain"] is not None for r in rows) >= 12
    via_columns = T.with_parsed_date(df, "v", "d").select(F.col("d").cast("string")).collect()
    assert via_columns == df.select(plain.cast("string")).collect()


def test_python_strip_variant(spark):
    assert one(spark, T.strip_py, "\x1c ab \x1f") == "ab"
    assert one(spark, T.strip, "\x1c ab \x1f") == "\x1c ab \x1f"


def test_date_parser_agrees_with_duckdb(spark):
    import duckdb
    from sheetfold import oracle as O
    texts = ["05/01/2025", "01/13/2025", "5.1.2025", "2025-1-5", "31/02/2025", "2024-01-05 10:00:00", " 05.01.2024",
             "05/01/25", "05-01-2024", "pendiente", "", "2024 - 01 - 05", "05/01/75", "05/01/68", "05/01/69",
             "29/02/72", "29/02/2023", "1/1/2000", "12/31/1999", "31-12-1999", "2000-2-29", "7/7/07"]
    con = duckdb.connect()
    con.execute("create table t (v varchar)")
    con.executemany("insert into t values (?)", [(t,) for t in texts])
    want = dict(con.sql(f"select v, cast({O.parse_date('v')} as varchar) from t").fetchall())
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = {r["v"]: r["d"] for r in df.select("v", T.parse_date_multi(F.col("v")).cast("string").alias("d")).collect()}
    assert got == want
