"""Grid readers: exported sheets → ``grid`` rows (``<keys>, row_idx, cells array<string>``)."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetfold.operators.headers import counted_names
from sheetfold.operators.joins import materialize, sized_side
from sheetfold.sources.mounted import list_exports, read_exports


#: Files above this size are reported, not read: a file is one value of its task.
MAX_FILE_BYTES = 1 << 30
#: Rows of a file sent on at a time.
_ROWS = 2048
_PARSED = "uri string, row_idx long, cells array<string>, n_rows long, reason string"


class Scan(NamedTuple):
    """What a set of files gave: ``grid`` rows of the files that parse, and every other file with its
    ``reason``; ``files`` has the rows (``n_rows``) of each file that parses."""

    grid: DataFrame
    failures: DataFrame
    files: DataFrame


class _Files(NamedTuple):
    """Files that were found: ``listed`` (``path``, ``length``; nothing is opened), the URI of a file of
    ``listed``, and how rows of ``listed`` become ``uri, content``."""

    listed: DataFrame
    uri: Column
    contents: Callable[[DataFrame], DataFrame]


def _records(raw: bytes):
    """The records of a CSV export: RFC 4180 quotes, strict; UTF-8 with or without its mark."""
    return csv.reader(io.TextIOWrapper(io.BytesIO(raw), encoding="utf-8-sig", newline=""), strict=True)


def _failure(raw: bytes) -> tuple[int, str | None]:
    """``(records, None)`` of a readable export, else ``(0, reason)``."""
    if b"\0" in raw:
        return 0, "holds NUL bytes: not a text file"
    try:
        return sum(1 for _ in _records(raw)), None
    except UnicodeDecodeError:
        return 0, "not UTF-8 text"
    except csv.Error:
        return 0, "broken quotes: not a CSV file"


def _parse(max_cols: int | None, trim: bool):
    schema = pa.schema([("uri", pa.string()), ("row_idx", pa.int64()), ("cells", pa.list_(pa.string())),
                        ("n_rows", pa.int64()), ("reason", pa.string())])

    def run(batches):
        csv.field_size_limit(MAX_FILE_BYTES)
        held = []

        def sent():
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held.clear()
            return out
        for batch in batches:
            for uri, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = content.as_py()
                # a file is read through before its first row leaves: a broken one gives no row
                n, reason = _failure(raw)
                held.append((uri, None, None, None if reason else n, reason))
                for i, row in enumerate(_records(raw) if n else ()):
                    cells = row[:max_cols]
                    if trim:
                        while cells and cells[-1] == "":
                            cells.pop()
                    held.append((uri, i, cells, None, None))
                    if len(held) >= _ROWS:
                        yield sent()
        if held:
            yield sent()
    return run


def scan_csv_grids(spark: SparkSession, paths: list[str], max_cols: int | None = None,
                   trim_trailing_blanks: bool = True, file_filter=None) -> Scan:
    """Read sheets exported as headerless CSV files in one pass: each file is opened once, its rows keep
    all their cells (or the first ``max_cols``, a range such as ``A:Z``), however many there are.

    A file that is no UTF-8 text, has broken quotes or NUL bytes, exceeds :data:`MAX_FILE_BYTES` or that
    Spark cannot read (a bad checksum, no permission) becomes a row of ``failures`` with a reason, and
    none of its rows is in ``grid``; the other files are not touched by it. An empty file has no rows
    (Spark passes over it) and is no failure. Blank cells are '';
    trailing blanks are trimmed as a sheet service does; ``row_idx`` counts a file's records from 0.
    ``file_filter`` (a function of the file's URI column) prunes files before they are opened.
    Parsed rows are written once to the shared folder: no later step opens an export again.
    """
    found = existing(spark, paths)
    return _scan(spark, [_load(spark, found, guarded=True)] if found else [], max_cols, trim_trailing_blanks, file_filter)


def _load(spark: SparkSession, paths: list[str], guarded: bool = False, **options) -> _Files:
    """Files by Spark's reader; ``guarded``: one that cannot be read gives no contents."""
    reader = spark.read.format("binaryFile").options(**options)
    files = (reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True) if guarded else reader).load(paths)
    uri = F.col("_metadata.file_path")
    return _Files(files, uri, lambda some: some.select(uri.alias("uri"), "content"))


def _scan(spark: SparkSession, files: list[_Files], max_cols: int | None, trim: bool, file_filter) -> Scan:
    """:func:`scan_csv_grids` of files that were found."""
    if not files:
        grid = spark.createDataFrame([], "file_id string, file_name string, row_idx long, cells array<string>")
        return Scan(grid, spark.createDataFrame([], "file_id string, file_name string, reason string"),
                    spark.createDataFrame([], "file_id string, n_rows long"))
    if file_filter is not None:
        files = [f._replace(listed=f.listed.where(file_filter(f.uri))) for f in files]
    contents = reduce(DataFrame.unionByName, [f.contents(f.listed.where(F.col("length") <= MAX_FILE_BYTES)) for f in files])
    parsed = materialize(contents.mapInArrow(_parse(max_cols, trim), _PARSED))
    name = F.element_at(F.split("file_id", "/"), -1)
    grid = parsed.where("row_idx is not null").select(F.col("uri").alias("file_id"), "row_idx", "cells")
    status = parsed.where("row_idx is null").select(F.col("uri").alias("file_id"), "n_rows", "reason", F.lit(True).alias("_read"))
    listed = reduce(DataFrame.unionByName, [f.listed.select(f.uri.alias("file_id"), "length") for f in files])     # nothing is opened
    failures = (listed.join(sized_side(status), "file_id", "left").where("_read is null or reason is not null")
                .withColumn("reason", F.coalesce("reason", F.when(F.col("length") > MAX_FILE_BYTES, F.lit("too large"))
                                                 .otherwise(F.lit("could not be read")))))
    return Scan(grid.select("file_id", name.alias("file_name"), "row_idx", "cells"),
                failures.select("file_id", name.alias("file_name"), "reason"),
                status.where("reason is null").select("file_id", "n_rows"))


def read_csv_grids(spark: SparkSession, paths: list[str], max_cols: int | None = None,
                   trim_trailing_blanks: bool = True, file_filter=None) -> DataFrame:
    """The rows of :func:`scan_csv_grids`: files that cannot be read are left out."""
    return scan_csv_grids(spark, paths, max_cols, trim_trailing_blanks, file_filter).grid


def any_match(spark: SparkSession, paths: list[str]) -> bool:
    """Whether any of the (glob) paths matches a file — a folder without matching files gives
    an empty grid instead of a failed read. Only file-system metadata is consulted."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no local JVM (Spark Connect): let the reader decide
        return True
    return any(_matches(jvm, conf, p) for p in paths)


def _matches(jvm, conf, p: str) -> bool:
    path = jvm.org.apache.hadoop.fs.Path(p)
    found = path.getFileSystem(conf).globStatus(path)
    return found is not None and len(found) > 0


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the (glob) paths that match a file (a read of one that matches none would fail)."""
    return [p for p in paths if any_match(spark, [p])]


def read_parquet_grid(spark: SparkSession, path: str) -> DataFrame:
    """A grid already stored as Parquet (``folder, file_id, file_name, file_ord, tab, row_idx,
    cells``); column pruning and filters reach the scan."""
    return spark.read.parquet(path)


def _decoded_path(c):
    # a URI keeps '+' literal, so protect it before form-style decoding
    return F.url_decode(F.regexp_replace(c, r"\+", "%2B"))


#: Two layouts of exports: one file per tab, or Spark's partitioned folders with the parts of a tab.
PLAIN, PARTITIONED = "<root>/<folder>/<workbook>/<tab>.csv", "<root>/folder=<folder>/workbook=<workbook>/tab=<tab>/part-*"


#: Names that Spark passes over when it lists the folders below a given one.
_PASSED_OVER = "{[_.]*,*._COPYING_}"


def _mounted(spark: SparkSession, roots: list[str]) -> tuple[list[str], list[str]]:
    """The folders of ``roots`` (patterns) on a mounted file system, as it names them, and those of ``roots`` that
    are elsewhere."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    here, elsewhere = {}, []
    for root in roots:
        path = jvm.org.apache.hadoop.fs.Path(root)
        fs = path.getFileSystem(conf)
        if fs.getUri().getScheme() == "file":
            here.update((s.getPath().toUri().getPath(), None) for s in fs.globStatus(path) or () if s.isDirectory())
        else:
            elsewhere.append(root)
    return list(here), elsewhere


def _export_folders(spark: SparkSession, roots: list[str]) -> dict[int, list[str]]:
    """Folders whose files, all together, are all exports under ``roots``, by the depth of the exports' folders:
    these themselves, and workbooks that Spark would pass over on its way down. The driver lists the
    entries of ``roots`` and of their folders; workbooks and tabs are left to the tasks of Spark's listing."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out: dict[int, dict[str, None]] = {}
    for root in roots:
        for depth, pattern in ((0, "*"), (1, f"*/{_PASSED_OVER}")):
            path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{pattern}")
            for status in path.getFileSystem(conf).globStatus(path) or ():
                if status.isDirectory():
                    out.setdefault(status.getPath().depth() - depth, {})[status.getPath().toString()] = None
    # names are no patterns
    return {depth: [re.sub(r"([{}\[\]*?\\])", r"\\\1", p) for p in paths] for depth, paths in out.items()}


def _export_files(spark: SparkSession, roots: list[str], guarded: bool = False) -> list[_Files]:
    """The files of both layouts under ``roots``. Below a mounted folder tasks list and open them; elsewhere
    Spark's reader does, whose driver keeps every file's name."""
    here, elsewhere = _mounted(spark, roots)
    out = [_Files(list_exports(spark, here), F.col("uri"), read_exports)] if here else []
    for depth, folders in _export_folders(spark, elsewhere).items():
        # binaryFile's ``path`` is the plain on-disk path (``_metadata.file_path`` is URI-encoded)
        parts = F.split(F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", ""), "/")
        levels = F.size(parts) - 1 - depth
        parted = F.lit(True)
        for i, start in ((-4, "folder="), (-3, "workbook="), (-2, "tab="), (-1, "part-")):
            parted = parted & F.element_at(parts, i).startswith(start)
        plain = (levels == 2) & F.element_at(parts, -1).endswith(".csv")
        files = _load(spark, folders, guarded, recursiveFileLookup=True)
        out.append(files._replace(listed=files.listed.where(plain | ((levels == 3) & parted))))
    return out


def export_place(on_disk) -> dict[str, Column]:
    """``folder, file_id, file_name, tab`` of an export's file from its path as it is on disk."""
    parts = F.split(on_disk, "/")
    parted = F.element_at(parts, -2).startswith("tab=")

    def value(i: int, name: str) -> Column:     # name=value
        return F.substring(F.element_at(parts, i), len(name) + 2, 10_000)
    folder = F.when(parted, value(-4, "folder")).otherwise(F.element_at(parts, -3))
    book = F.when(parted, value(-3, "workbook")).otherwise(F.element_at(parts, -2))
    tab = F.when(parted, value(-2, "tab")).otherwise(F.regexp_replace(F.element_at(parts, -1), r"\.csv$", ""))
    return {"folder": _decoded_path(folder), "file_name": _decoded_path(book), "tab": _decoded_path(tab),
            "file_id": F.when(parted, F.regexp_replace(on_disk, r"/[^/]*/[^/]*$", "")).otherwise(F.regexp_replace(on_disk, r"/[^/]*$", ""))}


def workbook_title(file_uri) -> Column:
    """Workbook title of an exported tab's file, from its URI."""
    return export_place(_decoded_path(file_uri))["file_name"]


def scan_workbook_exports(spark: SparkSession, roots: list[str], max_cols: int | None = None, tabs: list[str] | None = None,
                          title_filter=None) -> Scan:
    """Read workbooks exported in either layout (:data:`PLAIN`, :data:`PARTITIONED`): ``grid`` is ``folder,
    file_id (workbook path), file_name (workbook title), tab, row_idx, cells``; ``failures`` names the
    tabs that could not be read, ``folder, file_id, file_name, tab, reason``.

    Folder, workbook and tab names are percent-encoded path segments (titles may hold ``:`` or ``/``, which
    file systems reject); they are decoded here. ``tabs`` and ``title_filter`` (a predicate on the
    workbook title) are evaluated on file metadata and prune files before anything is opened. The
    parts of a tab follow each other by name; a tab with a part that cannot be read gives no row.
    """
    def wanted(uri):
        place = export_place(_decoded_path(uri))
        keep = place["tab"].isin(*tabs) if tabs else F.lit(True)
        return keep & title_filter(place["file_name"]) if title_filter is not None else keep

    scan = _scan(spark, _export_files(spark, roots, guarded=True), max_cols, True, wanted)
    place = export_place(_decoded_path(F.col("file_id")))
    sheet = ["folder", "file_id", "file_name", "tab"]
    failures = scan.failures.select(*[place[c].alias(c) for c in sheet], "reason")
    failures = failures.groupBy(*sheet).agg(F.min("reason").alias("reason"))
    # a part's rows go on where the parts before it end; per sheet there are few parts
    parts = scan.files.select(F.col("file_id").alias("_uri"), "n_rows", *[place[c].alias(c) for c in sheet])
    parts = parts.join(sized_side(failures.select("file_id", "tab"), checkpoint=True), ["file_id", "tab"], "left_anti")
    before = Window.partitionBy(*sheet).orderBy("_uri").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_uri", *sheet, F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("_start"))
    grid = scan.grid.select(F.col("file_id").alias("_uri"), "row_idx", "cells").join(sized_side(parts, checkpoint=True), "_uri")
    return Scan(grid.select(*sheet, (F.col("row_idx") + F.col("_start")).alias("row_idx"), "cells"), failures, scan.files)


def read_workbook_exports(spark: SparkSession, roots: list[str], max_cols: int | None = None, tabs: list[str] | None = None,
                          title_filter=None) -> DataFrame:
    """The rows of :func:`scan_workbook_exports`: tabs that cannot be read are left out."""
    return scan_workbook_exports(spark, roots, max_cols, tabs, title_filter).grid


def list_workbook_exports(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Workbooks and their tabs under ``roots`` (either layout) from file metadata only (no content is
    read): ``folder, file_id, file_name, tab, path``; a tab in parts has a row per part."""
    files = _export_files(spark, roots)
    if not files:
        return spark.createDataFrame([], "folder string, file_id string, file_name string, tab string, path string")
    place = export_place(F.col("path"))
    return reduce(DataFrame.unionByName, [f.listed.select("path") for f in files]).select(*[place[c].alias(c) for c in ("folder", "file_id", "file_name", "tab")], "path")


class UnreadableFile(ValueError):
    """A table that a job cannot do without cannot be read."""


def read_table_export(spark: SparkSession, path: str) -> DataFrame:
    """A tab exported with its header row (rates, project master): every column as text, named by
    the header's stripped names, blanks ``Unnamed`` and repeats numbered; blank cells are ''.
    :class:`UnreadableFile` if it cannot be read."""
    folder = f"{path.rstrip('/')}/*.csv"        # a table that Spark wrote is a folder of parts
    scan = scan_csv_grids(spark, [folder] if any_match(spark, [folder]) else [path])
    failed = scan.failures.first()
    if failed is not None:
        raise UnreadableFile(f"{path}: {failed['reason']}")
    heads = scan.grid.where("row_idx = 0")
    head = heads.orderBy("file_id").select("cells").first()
    if head is None:
        return spark.createDataFrame([], "Unnamed string")
    return scan.grid.where("row_idx > 0").select(*[
        F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(n) for i, n in enumerate(counted_names(head["cells"]))])
