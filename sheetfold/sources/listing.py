"""Workbook listings: folders of exported workbooks → ``workbooks`` DataFrame.

A listing is small metadata (one row per file); it is filtered *before* any grid is read so
pruned files are never opened.
"""

from __future__ import annotations

from pathlib import PurePosixPath
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetfold.functions import text as T
from sheetfold.operators.rowid import dense_index


def folder_id(url: str) -> str:
    """Folder id from a folder URL (the path segment behind ``folders``), or the bare id or path as it is."""
    path = urlsplit(url.strip()).path
    segments = PurePosixPath(path).parts
    return segments[segments.index("folders") + 1] if "folders" in segments[:-1] else path


def list_workbooks(spark: SparkSession, folders: list[str], glob: str = "*") -> DataFrame:
    """Files of several folders, appended in folder order: ``folder, file_id, file_name,
    file_ord, modified``. Only file metadata is read (``binaryFile`` without its content)."""
    frames = []
    for k, f in enumerate(folders):
        df = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(f)
              .select(F.col("path").alias("file_id"), F.col("modificationTime").alias("modified"))
              .withColumn("folder", F.lit(folder_id(f))).withColumn("_folder_ord", F.lit(k)))
        frames.append(df)
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    out = out.withColumn("file_name", F.element_at(F.split("file_id", "/"), -1))
    # listing order: folder order, then path
    return dense_index(out, ["_folder_ord", "file_id"], "file_ord", offset=1).drop("_folder_ord")


def ordered_listing(listing: DataFrame, folders: list[str], folder_col: str = "folder",
                    name_col: str = "file_name") -> DataFrame:
    """Listings of several folders appended in the given folder order, each folder listed by name;
    ``file_ord`` numbers the files 1, 2, … across folders (positions continue)."""
    rank = F.create_map(*[x for k, f in enumerate(folders) for x in (F.lit(f), F.lit(k))])
    ranked = listing.withColumn("_folder_rank", F.coalesce(F.try_element_at(rank, F.col(folder_col)), F.lit(len(folders))))
    return dense_index(ranked, ["_folder_rank", folder_col, name_col], "file_ord").drop("_folder_rank")


def append_listings(listings: list[DataFrame]) -> DataFrame:
    """Append listings of several folders (positions continue across folders)."""
    out = listings[0]
    for df in listings[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def dedupe_by_id(listing: DataFrame, id_col: str = "file_id", ord_col: str = "file_ord") -> DataFrame:
    """One row per id: the *last* listed record, kept at the id's *first* position
    (what a dict keyed by id, filled in listing order, yields)."""
    others = [c for c in listing.columns if c not in (id_col, ord_col)]
    g = listing.groupBy(id_col).agg(
        F.min(ord_col).alias(ord_col),
        F.max_by(F.struct(*[F.col(c) for c in others]), F.col(ord_col)).alias("_last"))
    return g.select(id_col, ord_col, *[F.col(f"_last.{c}").alias(c) for c in others])


def name_filter_ci(listing: DataFrame, prefix: str, exclude: str, name_col: str = "file_name") -> DataFrame:
    """Case-insensitive: upper(name) starts with ``prefix`` and lacks ``exclude``."""
    u = T.upper(F.col(name_col))
    return listing.where(u.startswith(prefix.upper()) & ~u.contains(exclude.upper()))


def name_filter_cs(listing: DataFrame, prefix: str | None, exclude: str, name_col: str = "file_name") -> DataFrame:
    """Case-sensitive: name starts with ``prefix`` and lacks ``exclude``; no prefix → no filter."""
    if not prefix:
        return listing
    n = F.col(name_col)
    return listing.where(n.startswith(prefix) & ~n.contains(exclude))
