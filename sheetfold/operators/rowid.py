"""Dense sequential ids without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetfold.operators.joins import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id(): partition id in the upper 31 bits


def dense_index(df: DataFrame, order_cols: list[str], name: str, offset: int = 1) -> DataFrame:
    """Number rows ``offset, offset+1, ...`` in ``order_cols`` order.

    The sort is range-partitioned (a hot file is split across tasks, unlike a per-file window),
    the ordered rows are checkpointed so the ids are stable on recomputation, then each
    partition's start is the prefix sum of the partition counts before it — a table with one row
    per partition, the only thing combined in a single task.
    """
    ordered = df.sort(*order_cols).withColumn("_mono", F.monotonically_increasing_id())
    ordered = materialize(ordered)
    ordered = ordered.withColumn("_part", F.shiftright(F.col("_mono"), _LOCAL_BITS))
    counts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_start"))
    local = F.col("_mono") - F.shiftleft(F.col("_part"), _LOCAL_BITS)
    return (ordered.join(F.broadcast(starts), "_part")
            .withColumn(name, (F.col("_start") + local + F.lit(offset)).cast("long"))
            .drop("_mono", "_part", "_start"))
