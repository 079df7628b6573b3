"""Real files: exports written and read back, broken files, ranges, replacement and named tables."""

import os
import struct
import zlib
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from sheetfold.operators.layout import slice_range
from sheetfold.operators.ranges import BadRange, Range, parse_range, read_range
from sheetfold.sources import grid as G
from sheetfold.sources import sinks as SK
from sheetfold.sources.catalog import Folder, catalog_name
from sheetfold.sources.exports import write_workbook_exports


def _sheet(rows):
    return "".join(",".join(r) + "\n" for r in rows)


def _put(root, folder, book, tab, data):
    d = os.path.join(root, quote(folder, safe=""), quote(book, safe=""))
    os.makedirs(d, exist_ok=True)
    path = os.path.join(d, quote(tab, safe="") + ".csv")
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


def _bad_checksum(path):
    """A checksum file beside ``path`` that its bytes do not meet: Hadoop refuses to read it."""
    with open(os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc"), "wb") as f:
        f.write(b"crc\0" + struct.pack(">I", 512) + struct.pack(">I", zlib.crc32(b"other")) * 8)


def _rows(df):
    return sorted((r.file_name, r.tab, r.row_idx, tuple(r.cells)) for r in df.select("file_name", "tab", "row_idx", "cells").collect())


def test_broken_files_among_a_hundred(spark, tmp_path):
    good, both = str(tmp_path / "good"), str(tmp_path / "both")
    for i in range(94):
        data = _sheet([[f"libro {i}", "año"], [], ['"a ""x"",\ny"', str(i), "", ""]])
        _put(good, "f", f"NUEVO {i}", "T: 1", data)
        _put(both, "f", f"NUEVO {i}", "T: 1", data)
    bad = {"corrupto": b"a,b\n1,\x00\x01\n", "latin": "año,b\n".encode("latin-1"), "utf16": "a,b\n".encode("utf-16"),
           "comillas": b'a,"b\nc,d\n', "suelta": b'a,"b"x\n', "suma": b"a,b\n"}
    for book, data in bad.items():
        path = _put(both, "f", f"NUEVO {book}", "T: 1", data)
    _bad_checksum(path)
    alone, scan = G.scan_workbook_exports(spark, [good]), G.scan_workbook_exports(spark, [both])
    want = _rows(alone.grid)
    assert len(want) == 3 * 94 and _rows(scan.grid) == want and alone.failures.count() == 0
    assert want[0] == ("NUEVO 0", "T: 1", 0, ("libro 0", "año")) and want[2][3] == ('a "x",\ny', "0")
    reasons = {r.file_name: r.reason for r in scan.failures.collect()}
    assert reasons == {"NUEVO corrupto": "holds NUL bytes: not a text file", "NUEVO latin": "not UTF-8 text",
                       "NUEVO utf16": "not UTF-8 text" if b"\0" not in bad["utf16"] else "holds NUL bytes: not a text file",
                       "NUEVO comillas": "broken quotes: not a CSV file", "NUEVO suelta": "broken quotes: not a CSV file",
                       "NUEVO suma": "could not be read"}


def test_one_pass_keeps_ten_thousand_columns(spark, tmp_path, monkeypatch):
    _put(str(tmp_path), "f", "b", "ancha", _sheet([["x"], [str(i) for i in range(10_000)], ["y", "z"]]))
    _put(str(tmp_path), "f", "b", "vacía", "")
    opened = []
    keep = G.materialize

    def counted(df):
        opened.append(df._jdf.queryExecution().executedPlan().toString())
        return keep(df)
    monkeypatch.setattr(G, "materialize", counted)
    scan = G.scan_workbook_exports(spark, [str(tmp_path)])
    rows = _rows(scan.grid)
    assert [len(r[3]) for r in rows] == [1, 10_000, 2] and rows[1][3][9_999] == "9999"
    assert scan.failures.count() == 0 and sorted(r.n_rows for r in scan.files.collect()) == [3]      # an empty file: no rows, no failure
    # the files' contents are scanned by the one plan that writes the parsed rows, and by no other
    assert len(opened) == 1 and opened[0].count("content#") > 0
    for df in scan:
        assert "content#" not in df._jdf.queryExecution().executedPlan().toString()


def test_partitioned_exports_round_trip(spark, tmp_path):
    rows = [("Carpeta 1", f"NUEVO: {b}/x", t, i, [f"{b}", "", 'dijo "sí", y\nno', str(i)] if i % 7 else [])
            for b in range(3) for t in ("Proyección - Ingresos", "a=b+c %41") for i in range(200 if b else 40)]
    grid = spark.createDataFrame(rows, "folder string, file_name string, tab string, row_idx long, cells array<string>")
    root = str(tmp_path / "out")
    write_workbook_exports(grid, root)
    assert _rows(G.read_workbook_exports(spark, [root])) == sorted((b, t, i, tuple(c)) for _, b, t, i, c in rows)
    some = G.read_workbook_exports(spark, [root], tabs=["Proyección - Ingresos"], title_filter=lambda t: t.startswith("NUEVO: 1"))
    assert {(r[0], r[1]) for r in _rows(some)} == {("NUEVO: 1/x", "Proyección - Ingresos")}
    listed = G.list_workbook_exports(spark, [root]).select("folder", "file_name", "tab").distinct().collect()
    assert {tuple(r) for r in listed} == {(f, b, t) for f, b, t, _, _ in rows}


def test_exports_are_written_without_a_process_per_file_and_listed_by_tasks(spark, tmp_path, monkeypatch):
    """Six hundred workbooks and odd names: parts without Hadoop's local writer (which starts processes for each
    file), one Spark listing from the folders down, and no pattern that makes the driver open every workbook."""
    odd = [("_f", "_libro.", "t"), (None, "", "%41 {x}[y]"), (".f", ".libro", "_t"), ("f*?", "a=b/c:d\\", "ñ")]
    rows = [("f", f"NUEVO {i}", "t", r, ["x", str(r)]) for i in range(600) for r in range(2)] + [(*k, r, ["é", "", '"']) for k in odd for r in range(2)]
    grid = spark.createDataFrame(rows, "folder string, file_name string, tab string, row_idx long, cells array<string>")
    root = str(tmp_path / "out")
    write_workbook_exports(grid, root)
    found = [(d, f) for d, _, names in os.walk(root) for f in names]
    assert len(found) >= 604 and all(f.startswith("part-") for _, f in found) and os.listdir(tmp_path) == ["out"]
    with pytest.raises(FileExistsError):
        write_workbook_exports(grid, root)
    monkeypatch.setattr(G, "any_match", None)
    name = lambda x: x or "__HIVE_DEFAULT_PARTITION__"
    want = sorted((name(b), t, i, tuple(c)) for _, b, t, i, c in rows)
    assert _rows(G.read_workbook_exports(spark, [root])) == want
    listed = {tuple(r) for r in G.list_workbook_exports(spark, [root]).select("folder", "file_name", "tab").collect()}
    assert listed == {(name(f), name(b), name(t)) for f, b, t, _, _ in rows}


def test_both_layouts_and_only_their_depths_are_listed(spark, tmp_path):
    root = str(tmp_path / "[r]")
    for folder, book, tab in [("_f", ".libro", "t"), ("f", "_libro", "t"), ("f", "libro", "t"), ("f", "libro", "_t")]:
        _put(root, folder, book, tab, "a,b\n")
    for other in ("suelto.csv", "f/suelto.csv", "f/libro/mas/hondo.csv", "f/libro/t.txt", "folder=g/workbook=b/part-0", "folder=g/workbook=b/tab=t/part-0"):
        os.makedirs(os.path.dirname(os.path.join(root, other)), exist_ok=True)
        with open(os.path.join(root, other), "w") as f:
            f.write("a,b\n")
    roots = [str(tmp_path / "\\[r\\]"), str(tmp_path / "none")]
    want = {("_f", ".libro", "t"), ("f", "_libro", "t"), ("f", "libro", "t"), ("g", "b", "t")}
    assert sorted(tuple(r)[:1] + tuple(r)[2:4] for r in G.list_workbook_exports(spark, roots).collect()) == sorted(want)
    assert sorted(tuple(r) for r in G.read_workbook_exports(spark, roots).select("folder", "file_name", "tab").collect()) == sorted(want)


@pytest.mark.parametrize("text, want", [
    ("'Proyección - Ingresos'!A:Z", Range("Proyección - Ingresos", 0, None, 0, 26)),
    ("A2:I", Range(None, 1, None, 0, 9)), ("a2:i", Range(None, 1, None, 0, 9)), ("B3:D10", Range(None, 2, 10, 1, 4)),
    ("D10:B3", Range(None, 2, 10, 1, 4)), ("2:5", Range(None, 1, 5, 0, None)), ("Datos!B3", Range("Datos", 2, 3, 1, 2)),
    ("'O''Brien'!AA1:AB", Range("O'Brien", 0, None, 26, 28)), ("'Toda'", Range("Toda", 0, None, 0, None)),
    ("Timesheet", Range("Timesheet", 0, None, 0, None)), ("C:A4", Range(None, 3, None, 0, 3)), ("Equipo!A:A", Range("Equipo", 0, None, 0, 1))])
def test_range_expressions(text, want):
    assert parse_range(text) == want


@pytest.mark.parametrize("text", ["", "!A:Z", "A:", ":Z", "A0:B", "A:3", "'T'!", "a b!A:Z", "A:B:C", "'T!A:Z", "A-Z", "$A$1"])
def test_bad_ranges_are_refused(text):
    with pytest.raises(BadRange):
        parse_range(text)


def test_read_range_equals_slices(spark):
    rows = [(t, i, [f"{t}{i}{c}" for c in "abcdefghijkl"[:12 - i]]) for t in ("x y", "z") for i in range(6)]
    grid = spark.createDataFrame(rows, "tab string, row_idx long, cells array<string>")
    own = grid.where("tab = 'x y'")
    assert sorted(read_range(grid, "'x y'!A2:I").collect()) == sorted(slice_range(own, 1, 0, 9).collect())
    assert sorted(read_range(grid, "A:Z").collect()) == sorted(grid.collect())
    got = sorted(tuple(r) for r in read_range(grid, "z!B3:C4").select("row_idx", "cells").collect())
    assert got == [(0, ["z2b", "z2c"]), (1, ["z3b", "z3c"])]


def test_a_run_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch):
    path, old, new = str(tmp_path / "t 1"), spark.range(5), spark.range(100, 103)
    assert SK.write_table(old, path) == 5

    class Killed(BaseException):
        pass

    def kill(*_):
        raise Killed
    # between the phases: the new table is complete, nothing is replaced
    monkeypatch.setattr(SK, "publish", kill)
    with pytest.raises(Killed):
        SK.write_table(new, path)
    monkeypatch.undo()
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [0, 1, 2, 3, 4]
    # during a write: a task fails
    with pytest.raises(Exception):
        SK.write_table(new.select(F.raise_error(F.lit("broken")).alias("id")), path)
    assert spark.read.parquet(path).count() == 5
    # a write that loses rows is not published
    keep = SK.Observation

    class Wrong(keep):
        get = {"rows": 4}
    monkeypatch.setattr(SK, "Observation", Wrong)
    with pytest.raises(SK.IncompleteWrite):
        SK.write_table(new, path)
    monkeypatch.undo()
    assert spark.read.parquet(path).count() == 5
    # between the two renames, as the process would leave it: the old table aside, the new one staged
    staged = str(tmp_path / ".t 1.staged-x")
    new.write.parquet(staged)
    os.rename(path, tmp_path / ".t 1.replaced-y")
    assert sorted(r.id for r in SK.read_table(spark, path).collect()) == [0, 1, 2, 3, 4]
    assert SK.write_table(new, path) == 3
    assert sorted(r.id for r in SK.read_table(spark, path).collect()) == [100, 101, 102]
    assert [f for f in os.listdir(tmp_path) if "replaced" in f] == []


def test_sorted_frames_are_read_back_in_order(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("k")).repartition(8).orderBy("k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")    # so small a table would be one file
    try:
        SK.write_table(df, str(tmp_path / "t"), fmt="csv")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = sorted(f for f in os.listdir(tmp_path / "t") if f.startswith("part-"))
    got = [int(x) for f in files for x in open(tmp_path / "t" / f).read().split()[1:]]
    assert got == sorted(got) and len(got) == 20_000 and len(files) > 1


def test_named_tables_are_found_or_created(spark, tmp_path):
    a, b = (Folder(spark, f"Carpeta '{k}' {tmp_path.name}", str(tmp_path / k)) for k in "ab")
    assert a.find("Resumen Alertas") is None
    assert a.save(spark.range(3), "Resumen Alertas") == ("created", 3)
    assert b.save(spark.range(4), "Resumen Alertas") == ("created", 4)      # two folders may hold one name
    assert a.save(spark.range(5), "Resumen Alertas") == ("replaced", 5)
    assert a.save(spark.range(0), "Resumen Alertas") == ("skipped", 0)
    assert (a.find("Resumen Alertas").count(), b.find("Resumen Alertas").count()) == (5, 4)
    assert a.save(spark.range(2), "resumen alertas") == ("created", 2)      # names are told apart by case
    assert a.save(spark.range(2).withColumn("x", F.current_date()), "resumen alertas") == ("replaced", 2)
    assert dict(a.find("resumen alertas").dtypes) == {"id": "bigint", "x": "string"}
    again = Folder(spark, a.title)
    assert again.names() == ["Resumen Alertas", "resumen alertas"] and again.location == a.location
    assert len(os.listdir(tmp_path / "a" / catalog_name("Resumen Alertas"))) == 1      # old versions are gone


def test_a_save_that_fails_leaves_the_named_table(spark, tmp_path):
    f = Folder(spark, f"fallo {tmp_path.name}", str(tmp_path / "f"))
    f.save(spark.range(3), "t")
    with pytest.raises(Exception):
        f.save(spark.range(9).select(F.raise_error(F.lit("broken")).cast("long").alias("id")), "t")
    assert f.find("t").count() == 3


def test_the_driver_holds_no_name_of_a_mounted_export(spark, tmp_path, monkeypatch):
    """Tasks list and open what lies on a mounted folder: no frame has the exports among the files that its driver keeps."""
    root = str(tmp_path / "out")
    rows = [("f", f"NUEVO {i}", "t", r, ["x", str(r)]) for i in range(40) for r in range(3)]
    write_workbook_exports(spark.createDataFrame(rows, "folder string, file_name string, tab string, row_idx long, cells array<string>"), root)
    _put(root, "f", "roto", "t", b"\0")
    monkeypatch.setattr(G, "_load", None)
    scan, listed = G.scan_workbook_exports(spark, [root, f"file://{root}/", str(tmp_path / "none")]), G.list_workbook_exports(spark, [root])
    assert [f for df in (*scan, listed) for f in df.inputFiles() if str(tmp_path) in f] == []
    assert _rows(scan.grid) == sorted((b, t, i, tuple(c)) for _, b, t, i, c in rows) and listed.count() == 41
    assert [tuple(r) for r in scan.failures.select("file_name", "reason").collect()] == [("roto", "holds NUL bytes: not a text file")]


def test_mounted_exports_are_listed_and_opened_as_by_sparks_reader(spark, tmp_path):
    root = str(tmp_path / "a b")
    data = b"a,b\n" * 400
    sums = lambda raw, n=512: b"crc\0" + struct.pack(">I", n) + b"".join(struct.pack(">I", zlib.crc32(raw[i:i + n])) for i in range(0, len(raw), n))
    crc = {"ok": sums(data), "100": sums(data, 100), "short": sums(data)[:-4], "long": sums(data) + b"1234", "bad": sums(data[1:]),
           "magic": b"x" + sums(data), "cut": b"crc\0\0", "zero": sums(data)[:4] + b"\0" * 4 + sums(data)[8:]}
    for name in [*crc, "t", "_t", "_t=1", ".t", "_metadata", "é  %41+;[{^}]'", "\U0001f600"]:
        os.makedirs(d := os.path.join(root, "f ü", "w"), exist_ok=True)
        with open(os.path.join(d, f"{name}.csv"), "wb") as f:
            f.write(data)
        if name in crc:
            with open(os.path.join(d, f".{name}.csv.crc"), "wb") as f:
                f.write(crc[name])
    open(os.path.join(d, "vacía.csv"), "w").close()
    os.symlink("/none", os.path.join(d, "nada.csv"))
    os.symlink(d, os.path.join(root, "f ü", "otro"))
    own = G._load(spark, [os.path.join(root, "f ü", b) for b in ("w", "otro")], guarded=True, pathGlobFilter="*.csv")
    files = G.list_exports(spark, [root])
    as_rows = lambda df: sorted(map(tuple, df.collect()))
    assert as_rows(files) == as_rows(own.listed.select("path", own.uri.alias("uri"), "length")) and files.count() == 24
    assert as_rows(G.read_exports(files)) == as_rows(own.contents(own.listed)) and G.read_exports(files).count() == 18
