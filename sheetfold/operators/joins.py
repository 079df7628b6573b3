"""Joins against small sides whose size is checked before anything is broadcast."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetfold.session import ensure_checkpoint_dir

#: Row bound under which a dimension or per-sheet layout is broadcast. Above it the join is a
#: shuffle join (AQE still splits skewed partitions); nothing unbounded is ever broadcast.
BROADCAST_MAX_ROWS = 200_000
#: Byte bound (JSON-encoded size of the rows) a broadcast side must also stay within.
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

#: Session settings that override :data:`BROADCAST_MAX_ROWS` / :data:`BROADCAST_MAX_BYTES`.
BROADCAST_MAX_ROWS_CONF = "sheetfold.broadcast.maxRows"
BROADCAST_MAX_BYTES_CONF = "sheetfold.broadcast.maxBytes"


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back: the plan runs once,
    its lineage is cut (survives executor loss; later reads see the same rows even when the plan
    is non-deterministic), and readers take only the columns they need."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_bound(df: DataFrame, max_rows: int | None = None) -> int:
    if max_rows is not None:
        return max_rows
    return int(df.sparkSession.conf.get(BROADCAST_MAX_ROWS_CONF, str(BROADCAST_MAX_ROWS)))


def sized_side(df: DataFrame, max_rows: int | None = None, checkpoint: bool = False) -> DataFrame:
    """Return ``df`` marked for broadcast only if it is within both bounds: rows (``max_rows``,
    else ``sheetfold.broadcast.maxRows``, else :data:`BROADCAST_MAX_ROWS`) and bytes
    (``sheetfold.broadcast.maxBytes``, else :data:`BROADCAST_MAX_BYTES`, measured as the
    JSON-encoded size of the rows). One job that reads at most ``max_rows + 1`` rows. Beyond the bounds
    it is marked for a merge join: left to itself, Spark broadcasts a stored table by the compressed size
    of its files, a small part of what the driver then holds.

    ``checkpoint=True`` first materialises it, so measuring does not run its plan twice (use it
    for sides computed from large inputs, such as per-sheet layouts).
    """
    max_rows = broadcast_bound(df, max_rows)
    max_bytes = int(df.sparkSession.conf.get(BROADCAST_MAX_BYTES_CONF, str(BROADCAST_MAX_BYTES)))
    if checkpoint:
        df = materialize(df)
    row_bytes = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    stats = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"),
                                       F.coalesce(F.sum(row_bytes), F.lit(0)).alias("b")).first()
    return F.broadcast(df) if stats["n"] <= max_rows and stats["b"] <= max_bytes else df.hint("merge")


def left_join_small(big: DataFrame, small: DataFrame, on, max_rows: int | None = None,
                    checkpoint: bool = False) -> DataFrame:
    """Left join that keeps every row of ``big``; duplicates on ``small`` fan out."""
    return big.join(sized_side(small, max_rows, checkpoint), on, "left")


def flag_membership(df: DataFrame, value_col: str, members: DataFrame, member_col: str,
                    flag: str = "_is_member", max_rows: int | None = None) -> DataFrame:
    """Add a boolean ``flag``: ``value_col`` appears in ``members[member_col]`` (nulls never do).

    A left join with the distinct member list, never ``isin(collect())``: the list is reduced
    by a distributed ``distinct`` and broadcast only behind the size check.
    """
    keys = (members.select(F.col(member_col).alias("_member_key"))
            .where(F.col("_member_key").isNotNull()).distinct()
            .withColumn(flag, F.lit(True)))
    out = df.join(sized_side(keys, max_rows), F.col(value_col) == F.col("_member_key"), "left")
    return out.withColumn(flag, F.coalesce(F.col(flag), F.lit(False))).drop("_member_key")


def missing_from(listed: DataFrame, processed: DataFrame, key: str, max_rows: int | None = None) -> DataFrame:
    """Rows of ``listed`` whose ``key`` never shows up in ``processed`` (set difference by id;
    the distinct processed ids — one per file — are broadcast behind the size check)."""
    return listed.join(sized_side(processed.select(key).distinct(), max_rows), key, "left_anti")
