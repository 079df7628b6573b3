"""Write grids as exported workbooks, in the partitioned layout that the readers take."""

from __future__ import annotations

import os
import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that Spark's writers escape in the name of a partition's folder, and the name that stands for no value.
_ESCAPED = re.compile(r"""[\x01-\x1F"#%'*/:=?\\\x7F{\[\]^]""")
_NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def csv_line(cells: Column) -> Column:
    """Cells as one RFC 4180 record; only cells that need quotes get them."""
    def quoted(c):
        return F.when(c.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    return F.array_join(F.transform(cells, lambda c: quoted(F.coalesce(c, F.lit("")))), ",")


def partition_folder(name: str, value: str | None) -> str:
    """``name=value`` as Spark's writers name a partition's folder."""
    return f"{name}={_ESCAPED.sub(lambda c: f'%{ord(c[0]):02X}', value) if value else _NO_VALUE}"


def _write_parts(folder: str):
    """Rows (``folder, workbook, tab, value`` in sheet order) → a part for each sheet of the task, and their
    number. A part gets its name when it is whole; the name is the same in each attempt of a task."""
    def run(batches):
        task = TaskContext.get()
        name, attempt = f"part-{task.partitionId():05d}", task.taskAttemptId()
        sheet, out, path, parts = None, None, None, 0
        try:
            for batch in batches:
                keys = [c.to_pylist() for c in batch.columns[:3]]
                changes = np.zeros(batch.num_rows, bool)
                changes[:1] = True
                for key in keys:
                    changes[1:] |= [a != b for a, b in zip(key, key[1:])]
                starts = np.flatnonzero(changes).tolist()
                lines = batch.column(3).to_pylist()
                for a, b in zip(starts, [*starts[1:], batch.num_rows]):
                    if sheet != (found := tuple(key[a] for key in keys)):
                        if out is not None:
                            out.close()
                            os.replace(out.name, path)
                        sheet, parts = found, parts + 1
                        to = os.path.join(folder, *map(partition_folder, ("folder", "workbook", "tab"), sheet))
                        os.makedirs(to, exist_ok=True)
                        path, out = os.path.join(to, name), open(os.path.join(to, f".{name}-{attempt}"), "wb")
                    out.writelines(x for line in lines[a:b] for x in (line or b"", b"\n"))
        finally:
            if out is not None:
                out.close()
        if out is not None:
            os.replace(out.name, path)
        yield pa.RecordBatch.from_arrays([pa.array([parts], pa.int64())], names=["parts"])
    return run


def write_workbook_exports(grid: DataFrame, root: str, line: Column | None = None) -> None:
    """``grid`` (``folder, file_name, tab, row_idx, cells``) as ``<root>/folder=/workbook=/tab=/part-*``.

    Rows are range-partitioned in sheet order, so a large tab is written by several tasks, as parts
    that follow each other by name. ``line`` replaces the record of a row (default: its cells).

    On a mounted folder the tasks write the parts themselves, beside ``root``, which appears at the end by one
    rename: without its native library Hadoop's local file system starts processes for every file (8.0 new
    processes and threads a file, as counted), and there is a file for each sheet. Elsewhere Spark's text writer is used.
    """
    rows = grid.select("folder", F.col("file_name").alias("workbook"), "tab", "row_idx",
                       (csv_line(F.col("cells")) if line is None else line).alias("value"))
    order = ["folder", "workbook", "tab", "row_idx"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row_idx")
    sc = grid.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file":
        rows.write.partitionBy("folder", "workbook", "tab").text(root)
        return
    if fs.exists(path):
        raise FileExistsError(root)
    whole = fs.makeQualified(path).toUri().getPath()
    staged = f"{whole}-{uuid.uuid4().hex}"
    os.makedirs(staged)
    names = [F.col(c).cast("string").alias(c) for c in order[:3]]
    (rows.select(*names, F.col("value").cast("binary").alias("value"))
     .mapInArrow(_write_parts(staged), "parts long").write.format("noop").mode("overwrite").save())
    os.rename(staged, whole)
