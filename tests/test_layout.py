"""Sheet layout on hand-written grids (FIXTURES.md §4)."""

from pyspark.sql import functions as F

from conftest import grid_df
from sheetfold.operators import layout as L
from sheetfold.plans import budget as BU
from sheetfold.plans import finance as FI


def lay_of(df):
    return {r["sheet"]: r for r in df.collect()}


def test_radar_fallback_and_bound(spark):
    sheets = {
        "found": [["Reporte"], ["x"], ["Proyecto", "USD"], ["P1", "1"]],
        "none": [["a", "b"], ["c", "d"], ["e", "f"]],
        "late": [["t"]] * 15 + [["Proyecto"], ["x"]],
    }
    lay = lay_of(L.sheet_layout(grid_df(spark, sheets), ["sheet"], FI.HEADER_KEYWORDS, 15, fallback_first_row=True))
    assert lay["found"]["header_idx"] == 2
    assert lay["none"]["header_idx"] == 0 and lay["none"]["header"] == ["a", "b"]
    assert lay["late"]["header_idx"] == 0          # keyword first on row 15: outside the window


def test_required_header_carve_and_guards(spark):
    sheets = {
        "ok": [["#REF!", "Resumen"], [" Nombre completo ", "Cantidad de horas"], ["ANA", "8,5"],
               ["LUIS", "4", "extra"], ["x", "Equipo externo"], ["EXT", "1,5"]],
        "deep": [["t"]] * 30 + [["Nombre completo", "Cantidad de horas"], ["A", "1"]],
        "tiny": [["Nombre completo"]],
        "nodata": [["Nombre completo", "Cantidad de horas"], ["TOTAL", "9"]],
    }
    g = L.blank_error_cells(grid_df(spark, sheets))
    assert g.where("sheet = 'ok' and row_idx = 0").first()["cells"] == ["", "Resumen"]
    lay = lay_of(L.sheet_layout(g, ["sheet"], BU.NAME_HEADER_KEYWORDS, 30, False, BU.STOP_KEYWORDS,
                                require_data=False))
    assert set(lay) == {"ok", "nodata"}            # deep: header below row 29; tiny: < 2 rows
    assert (lay["ok"]["header_idx"], lay["ok"]["stop_idx"], lay["ok"]["n_data"]) == (1, 4, 2)
    assert lay["nodata"]["n_data"] == 0
    with_data = lay_of(L.sheet_layout(g, ["sheet"], BU.NAME_HEADER_KEYWORDS, 30, False, BU.STOP_KEYWORDS))
    assert set(with_data) == {"ok"}
    width = lay_of(L.carved_width(g, BU.team_layout(g, ["sheet"]), ["sheet"]))
    assert width["ok"]["width"] == 3               # ragged row widens the table


def test_stop_marker_far_below_header(spark):
    rows = [["Nombre completo", "Cantidad de horas"]] + [[f"P{i}", "1"] for i in range(60)] + [["Total", "60"], ["Z", "1"]]
    g = grid_df(spark, {"s": rows})
    lay = L.sheet_layout(g, ["sheet"], BU.NAME_HEADER_KEYWORDS, 30, False, BU.STOP_KEYWORDS).first()
    assert (lay["header_idx"], lay["stop_idx"], lay["n_data"]) == (0, 61, 60)


def test_marker_above_header_is_ignored(spark):
    rows = [["Total general"], ["Nombre completo", "Cantidad de horas"], ["A", "1"], ["B", "2"]]
    lay = L.sheet_layout(grid_df(spark, {"s": rows}), ["sheet"], BU.NAME_HEADER_KEYWORDS, 30, False,
                         BU.STOP_KEYWORDS).first()
    assert (lay["header_idx"], lay["stop_idx"], lay["n_data"]) == (1, None, 2)


def test_finance_ragged_row_adds_column(spark):
    g = grid_df(spark, {"s": [["Proyecto", "USD"], ["P", "1", "extra"]]}, extra={"tipo": lambda k: "Ingreso"})
    lay = FI.finance_layout(g, ["sheet"], "tipo").first()
    assert lay["width"] == 3 and lay["names"] == ["Proyecto", "USD", "column_2"]


def test_fit_cells_pads_and_cuts(spark):
    df = spark.createDataFrame([(["a"],), (["a", "b", "c"],)], "c array<string>")
    got = [r[0] for r in df.select(L.fit_cells(F.col("c"), F.lit(2))).collect()]
    assert got == [["a", ""], ["a", "b"]]
    assert [r[0] for r in df.select(L.fit_cells(F.col("c"), F.lit(0))).collect()] == [[], []]


def test_slice_range_a2i(spark):
    g = grid_df(spark, {"s": [["t"], [str(i) for i in range(12)], ["x"]]})
    out = {r["row_idx"]: r["cells"] for r in L.slice_range(g, first_row=1, n_cols=9).collect()}
    assert out == {0: [str(i) for i in range(9)], 1: ["x"]}


def test_row_map(spark):
    from sheetfold.operators import headers as H
    g = grid_df(spark, {"s": [["Proyecto", "", "Proyecto"], ["P1", "x"], ["P2", "y", "z", "extra"]]})
    lay = L.first_row_layout(g, ["sheet"]).withColumn("names", H.dedupe_checked(F.col("header")))
    rows = L.table_rows(g, lay.select("sheet", "header_idx", "stop_idx", "names"), ["sheet"])
    got = {r["row_idx"]: r["m"] for r in rows.select("row_idx", L.row_map(F.col("names"), F.col("cells"), F.size("names")).alias("m")).collect()}
    assert got == {1: {"Proyecto": "P1", "column_1": "x", "Proyecto_1": ""}, 2: {"Proyecto": "P2", "column_1": "y", "Proyecto_1": "z"}}
