"""Sinks: write export tables without collecting them to the driver."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ProtectedDestination(ValueError):
    """Raised when a write targets one of the protected (source) folders."""


def _location(spark: SparkSession, path: str) -> tuple:
    """File system and path components of a path, qualified as the cluster's file systems do
    (relative paths, ``file:`` and ``hdfs:`` forms of one place are equal)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = jvm.org.apache.hadoop.fs.FileSystem
    default = fs.getDefaultUri(conf)
    p = jvm.org.apache.hadoop.fs.Path(path)
    if p.toUri().getScheme() == "file" and default.getScheme() != "file":
        default = jvm.java.net.URI("file:///")
    q = p.makeQualified(default, fs.get(conf).getWorkingDirectory()).toUri()
    return (q.getScheme(), q.getAuthority() or "", *[x for x in q.getPath().split("/") if x])


def check_destination(spark: SparkSession, path: str, protected: list[str]) -> None:
    """Refuse a destination that is a protected folder, lies in one or holds one."""
    to = _location(spark, path)
    for p in protected:
        source = _location(spark, p)
        n = min(len(to), len(source))
        if to[:n] == source[:n]:
            raise ProtectedDestination(f"{path} would overwrite {p}")


def dates_to_text(df: DataFrame) -> DataFrame:
    """Date and timestamp columns become text (``yyyy-MM-dd`` / ISO); others unchanged."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def null_to_blank(df: DataFrame) -> DataFrame:
    """Every column as text with null → '' (the export's value rule; header stays the names)."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])


def export_frame(df: DataFrame) -> DataFrame:
    """Dates to text, then null → ''."""
    return null_to_blank(dates_to_text(df))


def _folder(spark: SparkSession, path: str):
    """The file system of ``path``, its parent folder and its name there."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p, p.getParent(), p.getName()


def _siblings(spark: SparkSession, path: str, kind: str) -> list:
    """What a swap left beside ``path``, oldest first."""
    fs, _, parent, name = _folder(spark, path)
    found = [f for f in fs.listStatus(parent) if f.getPath().getName().startswith(f".{name}.{kind}-")] if fs.exists(parent) else []
    return sorted(found, key=lambda f: f.getModificationTime())


def _sibling(spark: SparkSession, parent, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(parent, name)


def recover(spark: SparkSession, path: str) -> bool:
    """Put the table at ``path`` right after a run that died while it was replaced: if the swap had begun
    and not ended, the previous table goes back to its place (True). Leftovers of ended swaps go."""
    fs, p, _, _ = _folder(spark, path)
    replaced = _siblings(spark, path, "replaced")
    restored = bool(replaced) and not fs.exists(p)
    if restored:
        fs.rename(replaced.pop().getPath(), p)
    for f in replaced:
        fs.delete(f.getPath(), True)
    return restored


def publish(spark: SparkSession, staged: str, path: str) -> None:
    """Put the complete folder ``staged`` in the place of ``path`` by two renames. Readers see the old
    table or the new one; a run that dies between the renames leaves both, and :func:`recover`, which
    every write and :func:`read_table` begin with, puts the old one back."""
    fs, p, parent, name = _folder(spark, path)
    new = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staged)
    old = _sibling(spark, parent, f".{name}.replaced-{uuid.uuid4().hex}")
    there = fs.exists(p)
    if there and not fs.rename(p, old):
        raise OSError(f"{path} could not be moved away")
    if not fs.rename(new, p):
        if there:
            fs.rename(old, p)
        raise OSError(f"{path} could not be replaced")
    if there:
        fs.delete(old, True)


class IncompleteWrite(OSError):
    """The files of a write do not hold the rows that went into it."""


#: Values exactly as computed: RFC 4180 quotes, blanks written empty, no whitespace trimming.
CSV_OUT = {"header": True, "emptyValue": "", "escape": '"', "ignoreLeadingWhiteSpace": False,
           "ignoreTrailingWhiteSpace": False}
CSV_IN = {"header": True, "escape": '"', "multiLine": True}


def stage(df: DataFrame, folder: str, fmt: str) -> int:
    """Write ``df`` to ``folder`` and compare the rows that its files hold with those that went in, counted
    during the write (:class:`IncompleteWrite`). Returns the rows."""
    spark = df.sparkSession
    seen = Observation(f"rows_{uuid.uuid4().hex}")
    out = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    out.write.options(**(CSV_OUT if fmt == "csv" else {})).format(fmt).save(folder)
    rows = int(seen.get["rows"])
    back = spark.read.options(**(CSV_IN if fmt == "csv" else {})).format(fmt).schema(df.schema).load(folder)
    if (held := back.count()) != rows:
        raise IncompleteWrite(f"{folder} holds {held} of {rows} rows")
    return rows


def write_table(df: DataFrame, path: str, fmt: str = "parquet", skip_empty: bool = True,
                protected: list[str] | None = None, num_files: int | None = None) -> int | None:
    """Replace the table at ``path`` with ``df`` (export rules applied for text formats).

    * refuses a destination that is, lies in or holds a protected folder (``ProtectedDestination``);
    * an empty ``df`` leaves the previous output untouched when ``skip_empty`` (returns None);
    * the new table is written beside the old one, its rows are compared with those observed during
      the write, and only then does it take the old one's place (:func:`publish`): a run that dies
      or fails before leaves the old table as it was;
    * files are in the order of ``df``'s partitions: a sorted frame is read back sorted by file name;
    * write errors propagate (no silent give-up);
    * returns the number of rows written.
    """
    spark = df.sparkSession
    check_destination(spark, path, protected or [])
    recover(spark, path)
    out = export_frame(df) if fmt == "csv" else dates_to_text(df)
    if num_files:
        out = out.coalesce(num_files)
    fs, _, parent, name = _folder(spark, path)
    staged = _sibling(spark, parent, f".{name}.staged-{uuid.uuid4().hex}")
    try:
        rows = stage(out, staged.toString(), fmt)
        if not rows and skip_empty:
            return None
        publish(spark, staged.toString(), path)
    finally:
        fs.delete(staged, True)         # there if nothing was to be published, or something failed
    return rows


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The published table at ``path``, after :func:`recover`; CSV as text with its header."""
    recover(spark, path)
    return spark.read.options(**(CSV_IN if fmt == "csv" else {})).format(fmt).load(path)
