"""Exports on a mounted folder: tasks list and open them, so that no file's name is kept by the driver."""

from __future__ import annotations

import math
import os
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetfold.operators.joins import materialize
from sheetfold.session import MAX_SHUFFLE_PARTITIONS

#: What a task reads in the time that opening a file takes it.
OPEN_BYTES = 1 << 14
#: Rows, and bytes of contents, sent on at a time.
_ROWS, _BYTES = 4096, 4 << 20
_FOLDER = pa.schema([("path", pa.string())])
_FILE = pa.schema([("path", pa.string()), ("uri", pa.string()), ("length", pa.int64())])
_CONTENT = pa.schema([("uri", pa.string()), ("content", pa.binary())])
#: Characters that Java's URIs escape in a path.
_QUOTED = re.compile(r"[^A-Za-z0-9_\-!.~'()*,;:$&+=/@\x80-\U0010FFFF]|[\x80-\x9F\s]")


def _uri(path: str) -> str:
    return "file:" + _QUOTED.sub(lambda c: "".join(f"%{b:02X}" for b in c[0].encode()), path)


def _sent(rows, schema: pa.Schema, weight, most: int):
    """``rows`` as batches of a ``weight`` of ``most`` or just above."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _entries(folder: str):
    """What a folder holds; nothing if it is gone. Names that are no text are passed over, as Java does."""
    try:
        with os.scandir(folder) as found:
            for entry in found:
                if entry.name.isascii() or not re.search("[\uD800-\uDFFF]", entry.name):
                    yield entry
    except (FileNotFoundError, NotADirectoryError):
        return


def _passed_over(name: str) -> bool:
    """Spark's rule for names below a folder that it lists."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _folders(batches):
    """Folders (``path``) → the folders in them."""
    rows = ((e.path,) for batch in batches for path in batch.column(0).to_pylist() for e in _entries(path) if e.is_dir())
    yield from _sent(rows, _FOLDER, lambda _: 1, _ROWS)


def _exports(book: str):
    """The exports of a workbook in either layout, files that hold nothing left out: ``path, uri, length``."""
    folder, title = book.rsplit("/", 2)[-2:]
    parted = folder.startswith("folder=") and title.startswith("workbook=")
    for entry in _entries(book):
        if _passed_over(entry.name):
            continue
        if entry.is_dir():
            files = (e for e in _entries(entry.path) if e.name.startswith("part-") and not _passed_over(e.name) and not e.is_dir())
            files = files if parted and entry.name.startswith("tab=") else ()
        else:
            files = (entry,) if entry.name.endswith(".csv") else ()
        for file in files:
            try:
                length = file.stat().st_size
            except FileNotFoundError:
                continue
            if length:
                yield f"file:{file.path}", _uri(file.path), length


def _files(batches):
    """Workbooks (``path``) → their exports."""
    rows = (row for batch in batches for book in batch.column(0).to_pylist() for row in _exports(book))
    yield from _sent(rows, _FILE, lambda _: 1, _ROWS)


def list_exports(spark: SparkSession, roots: list[str]) -> DataFrame:
    """The files of both layouts under ``roots`` (paths of mounted folders), listed once, by tasks: ``path, uri,
    length``, the first two as Spark's ``binaryFile`` has them in ``path`` and ``_metadata.file_path``."""
    found = spark.createDataFrame([(r,) for r in roots], "path string").mapInArrow(_folders, "path string")
    found = found.repartition("path").mapInArrow(_folders, "path string")
    return materialize(found.repartition("path").mapInArrow(_files, "path string, uri string, length long"))


def _content(path: str) -> bytes:
    """A file's bytes. Checksums beside it (Hadoop's ``.<name>.crc``) are compared; OSError if they differ."""
    with open(path, "rb") as f:
        raw = f.read()
    folder, name = os.path.split(path)
    try:
        with open(os.path.join(folder, f".{name}.crc"), "rb") as f:
            sums = f.read()
    except OSError:
        return raw
    if len(sums) < 8 or sums[:4] != b"crc\0":
        return raw
    step = int.from_bytes(sums[4:8], "big", signed=True)
    if step <= 0 or not sums[8:].startswith(b"".join(
            zlib.crc32(raw[i:i + step]).to_bytes(4, "big") for i in range(0, len(raw), step))):
        raise OSError(f"checksum error: {path}")
    return raw


def _contents(batches):
    """Files (``path, uri``) → ``uri, content`` of those that can be read."""
    def rows():
        for batch in batches:
            for path, uri in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                try:
                    yield uri, _content(path.removeprefix("file:"))
                except OSError:
                    continue
    yield from _sent(rows(), _CONTENT, lambda row: len(row[1]) + _BYTES // _ROWS, _BYTES)


def read_exports(files: DataFrame) -> DataFrame:
    """``uri, content`` of the ``files`` of :func:`list_exports` that can be read. Tasks get what Spark puts in a
    split, a file counted with what opening it costs."""
    spark = files.sparkSession
    n, length = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    tasks = max(math.ceil((length + n * OPEN_BYTES) / split), min(n, spark.sparkContext.defaultParallelism), 1)
    return (files.select("path", "uri").repartition(min(tasks, MAX_SHUFFLE_PARTITIONS), "path")
            .mapInArrow(_contents, "uri string, content binary"))
