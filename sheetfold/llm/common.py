"""What the operators share: stored intermediate tables and column-name safety."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetfold.session import ensure_checkpoint_dir

#: A word: the longest run of characters other than the six ASCII white-space ones.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def store(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet to the cluster's shared folder (``spark.checkpoint.dir``) and read
    it back: cuts the lineage, is computed once and survives lost executors."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made unlike every column of ``df`` (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, whatever the number of its uses."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_count(text: Column) -> Column:
    """Words of a text; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")
