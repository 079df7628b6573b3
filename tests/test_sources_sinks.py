"""Listings, grid readers and sinks."""

import csv
import datetime as dt
import os
import tempfile

import pytest

from sheetfold.sources import grid as G
from sheetfold.sources import listing as LS
from sheetfold.sources import sinks as SK


def test_folder_id():
    assert LS.folder_id("https://host/drive/folders/abc123?usp=sharing") == "abc123"
    assert LS.folder_id(" abc123 ") == "abc123"


def test_dedupe_last_record_first_position(spark):
    lst = spark.createDataFrame([(1, 1, "a"), (2, 2, "b"), (1, 3, "a2"), (3, 4, "c")],
                                "file_id int, file_ord int, file_name string")
    got = {r["file_id"]: (r["file_ord"], r["file_name"]) for r in LS.dedupe_by_id(lst).collect()}
    assert got == {1: (1, "a2"), 2: (2, "b"), 3: (4, "c")}


def test_name_filters(spark):
    lst = spark.createDataFrame([("Timesheet 2026 - A",), ("timesheet 2026 - B",), ("Timesheet 2026 - Plantilla",),
                                 ("NUEVO x",), ("nuevo (copia)",)], "file_name string")
    assert [r[0] for r in LS.name_filter_cs(lst, "Timesheet 2026 -", "Plantilla").collect()] == ["Timesheet 2026 - A"]
    assert LS.name_filter_cs(lst, None, "Plantilla").count() == 5
    assert [r[0] for r in LS.name_filter_ci(lst, "nuevo", "COPIA").collect()] == ["NUEVO x"]


def _write_csv(path, rows):
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows(rows)


def test_csv_grid_reader_and_listing(spark):
    d = tempfile.mkdtemp(prefix="grid-", dir="/tmp")
    _write_csv(os.path.join(d, "a.csv"), [["Título", "", ""], ["Nombre completo", "Cantidad de horas"],
                                          ["ANA", "8,5", "", ""], ["multi\nline", "1"], ["", ""], ["z", "2"]])
    _write_csv(os.path.join(d, "b.csv"), [["x"], ["y", "1"]])
    g = G.read_csv_grids(spark, [os.path.join(d, "a.csv"), os.path.join(d, "b.csv")], max_cols=26)
    rows = {(r["file_name"], r["row_idx"]): r["cells"] for r in g.collect()}
    assert rows[("a.csv", 0)] == ["Título"]
    assert rows[("a.csv", 2)] == ["ANA", "8,5"]
    assert rows[("a.csv", 3)] == ["multi\nline", "1"]
    assert rows[("a.csv", 4)] == []
    assert rows[("a.csv", 5)] == ["z", "2"]
    assert rows[("b.csv", 1)] == ["y", "1"]
    lst = LS.list_workbooks(spark, [d], glob="*.csv")
    assert sorted((r["file_name"], r["file_ord"]) for r in lst.collect()) == [("a.csv", 1), ("b.csv", 2)]


def test_sink_rules(spark):
    d = tempfile.mkdtemp(prefix="sink-", dir="/tmp")
    df = spark.createDataFrame([(" a ", None, dt.date(2025, 1, 5), 1.5)], "x string, y string, d date, v double")
    out = SK.export_frame(df).first()
    assert out.asDict() == {"x": " a ", "y": "", "d": "2025-01-05", "v": "1.5"}
    path = os.path.join(d, "table")
    assert SK.write_table(df, path, fmt="csv") == 1
    first = spark.read.option("header", True).csv(path).first()
    assert first["d"] == "2025-01-05" and first["x"] == " a "      # values exported untrimmed
    # empty result: previous output stays
    assert SK.write_table(df.limit(0), path, fmt="csv") is None
    assert spark.read.option("header", True).csv(path).count() == 1
    # unless asked to replace it
    assert SK.write_table(df.limit(0), path, fmt="csv", skip_empty=False) == 0
    assert spark.read.option("header", True).csv(path).count() == 0
    # protected destinations are refused
    with pytest.raises(SK.ProtectedDestination):
        SK.write_table(df, os.path.join(d, "src", "t"), protected=[os.path.join(d, "src")])


def test_scale_conf():
    from sheetfold.session import scale_conf
    assert scale_conf(100 * 1024 ** 4, 8000)["spark.sql.shuffle.partitions"] == "100000"   # capped
    assert scale_conf(10 * 1024 ** 4, 8000)["spark.sql.shuffle.partitions"] == "88000"     # 81,920 splits → 11 waves
    assert scale_conf(0, 8)["spark.sql.shuffle.partitions"] == "8"


def test_broadcast_bound_setting(spark):
    from sheetfold.operators.joins import broadcast_bound, sized_side

    def hinted(df):
        return "broadcast" in df._jdf.queryExecution().logical().toString().lower()

    df = spark.range(3)
    assert broadcast_bound(df) == 200_000 and hinted(sized_side(df))
    spark.conf.set("sheetfold.broadcast.maxRows", "2")
    try:
        assert broadcast_bound(df) == 2 and not hinted(sized_side(df))
    finally:
        spark.conf.unset("sheetfold.broadcast.maxRows")
    spark.conf.set("sheetfold.broadcast.maxBytes", "10")       # three rows of {"id":n} are 24 bytes
    try:
        assert not hinted(sized_side(df))
    finally:
        spark.conf.unset("sheetfold.broadcast.maxBytes")


def test_csv_grid_keeps_range_width(spark):
    d = tempfile.mkdtemp(prefix="wide-", dir="/tmp")
    _write_csv(os.path.join(d, "w.csv"), [[f"c{i}" for i in range(30)], ["a", "b"]])
    rows = G.read_csv_grids(spark, [os.path.join(d, "w.csv")], max_cols=26).orderBy("row_idx").collect()
    assert rows[0]["cells"] == [f"c{i}" for i in range(26)] and rows[1]["cells"] == ["a", "b"]


def test_csv_grid_rfc_quotes(spark):
    d = tempfile.mkdtemp(prefix="quotes-", dir="/tmp")
    _write_csv(os.path.join(d, "q.csv"), [['{"k": 23}', 'say "hi", ok', "a\nb"]])
    assert G.read_csv_grids(spark, [os.path.join(d, "q.csv")]).first()["cells"] == ['{"k": 23}', 'say "hi", ok', "a\nb"]


def _scan_files(df):
    """``numFiles`` of every file scan in the final (adaptive) plan."""
    found = []

    def walk(p):
        name = p.nodeName()
        if "Scan" in name and p.metrics().contains("numFiles"):
            found.append(p.metrics().apply("numFiles").value())
        if name.startswith("AdaptiveSparkPlan"):
            walk(p.executedPlan())
        elif "QueryStage" in name:
            walk(p.plan())
        ch = p.children()
        for i in range(ch.size()):
            walk(ch.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_title_filter_prunes_files_before_reading(spark, monkeypatch):
    from urllib.parse import quote
    from sheetfold.plans import finance as FI
    root = tempfile.mkdtemp(prefix="prune-", dir="/tmp")
    for book in ["NUEVO a", "nuevo b", "viejo c", "NUEVO d (Copia)"]:
        for tab in [FI.INCOME_TAB, FI.EXPENSE_TAB]:
            d = os.path.join(root, "f", quote(book, safe=""))
            os.makedirs(d, exist_ok=True)
            _write_csv(os.path.join(d, quote(tab, safe="") + ".csv"), [["Proyecto"], [book]])
    g = G.read_workbook_exports(spark, [root], tabs=[FI.INCOME_TAB], title_filter=FI.finance_name_ok)
    rows = g.select("file_name", "tab", "row_idx").collect()
    assert sorted({r["file_name"] for r in rows}) == ["NUEVO a", "nuevo b"] and {r["tab"] for r in rows} == {FI.INCOME_TAB}
    monkeypatch.setattr(G, "materialize", lambda df: df)     # keep the scan of the files in the plan
    raw = G.read_csv_grids(spark, [f"{root}/*/*/{quote(FI.INCOME_TAB, safe='')}.csv"], max_cols=26,
                           file_filter=lambda uri: FI.finance_name_ok(G.workbook_title(uri)))
    raw = raw.select("file_id").distinct()
    raw.collect()
    assert set(_scan_files(raw)) == {2}       # two of the four income files were opened


def test_list_workbooks_appends_folders_in_order(spark):
    a, b = (tempfile.mkdtemp(prefix=f"lst{k}-", dir="/tmp") for k in (1, 2))
    for d, names in [(a, ["z.csv", "m.csv"]), (b, ["a.csv"])]:
        for n in names:
            _write_csv(os.path.join(d, n), [["x"]])
    got = [(r["folder"], r["file_name"], r["file_ord"]) for r in
           LS.list_workbooks(spark, [b, a], glob="*.csv").orderBy("file_ord").collect()]
    assert got == [(b, "a.csv", 1), (a, "m.csv", 2), (a, "z.csv", 3)]


def test_protected_folders_are_refused_in_any_form(spark, tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    df = spark.range(3)
    df.write.parquet(str(tmp_path / "exports" / "in"))
    hdfs = "hdfs://nn:8020/data/in"
    cases = [(str(tmp_path / "exports"), [f"file:{tmp_path}/exports"]), (f"file://{tmp_path}/exports/x", [str(tmp_path / "exports")]),
             (str(tmp_path), [str(tmp_path / "exports" / "in")]), (hdfs + "/sub", [hdfs]), (hdfs, [hdfs + "/"]), ("hdfs://nn:8020/data", [hdfs])]
    for path, protected in cases:
        with pytest.raises(SK.ProtectedDestination):
            SK.write_table(df, path, protected=protected)
    assert spark.read.parquet(str(tmp_path / "exports" / "in")).count() == 3
    SK.check_destination(spark, "hdfs://nn:8020/data/in2", [hdfs])
    SK.check_destination(spark, str(tmp_path / "exports2"), [str(tmp_path / "exports")])
    assert SK.write_table(df, str(tmp_path / "other"), protected=[str(tmp_path / "exports")]) == 3


def test_wide_rows_and_table_headers(spark, tmp_path):
    (tmp_path / "wide.csv").write_text('a,"x, ""y""\nz",' + ",".join(str(i) for i in range(40)) + "\nshort\n", encoding="utf-8")
    rows = G.read_csv_grids(spark, [str(tmp_path / "wide.csv")]).orderBy("row_idx").collect()
    assert len(rows[0].cells) == 42 and rows[0].cells[1] == 'x, "y"\nz' and rows[1].cells == ["short"]
    assert len(G.read_csv_grids(spark, [str(tmp_path / "wide.csv")], max_cols=26).orderBy("row_idx").first().cells) == 26
    (tmp_path / "rates.csv").write_text("Nombre , Costo interno,,X,X\nAna,5\n", encoding="utf-8")
    t = G.read_table_export(spark, str(tmp_path / "rates.csv"))
    assert t.columns == ["Nombre", "Costo interno", "Unnamed", "X", "X_1"]
    assert tuple(t.first()) == ("Ana", "5", "", "", "")


def test_no_data_runs_fail(spark):
    from sheetfold.plans import timesheets as TS

    projects = spark.createDataFrame([("P",)], "`Nombre de Proyecto` string")
    with pytest.raises(TS.NoData):
        TS.check_projects(projects.limit(0))
    with pytest.raises(TS.NoData):
        TS.check_projects(spark.createDataFrame([("P",)], "x string"))
    grid = spark.createDataFrame([], "file_id string, file_name string, sector string, row_idx long, cells array<string>")
    rates = spark.createDataFrame([("a", "1")], "Nombre string, `Costo interno` string")
    with pytest.raises(TS.NoData):
        TS.run_from_grids(grid, ["file_id"], rates, projects, sector_col="sector")
