"""Dense ids with a hot file holding most rows."""

from pyspark.sql import functions as F

from sheetfold.operators.rowid import dense_index


def test_dense_index_skewed(spark):
    # file 1 holds two thirds of the rows
    df = spark.range(0, 30_000).select(
        F.when(F.col("id") < 20_000, F.lit(1)).otherwise((F.col("id") % 7) + 2).alias("file_ord"),
        F.col("id").alias("row_idx"))
    out = dense_index(df.repartition(13), ["file_ord", "row_idx"], "rid", offset=1)
    rows = out.select("file_ord", "row_idx", "rid").collect()
    assert len(rows) == 30_000
    assert sorted(r["rid"] for r in rows) == list(range(1, 30_001))
    by_order = [r["rid"] for r in sorted(rows, key=lambda r: (r["file_ord"], r["row_idx"]))]
    assert by_order == list(range(1, 30_001))


def test_sort_splits_a_hot_file_across_partitions(spark):
    # the range-partitioned sort behind dense_index must not put one file in one task
    df = spark.range(0, 40_000).select(
        F.when(F.col("id") < 30_000, F.lit(1)).otherwise(F.lit(2)).alias("file_ord"), F.col("id").alias("row_idx"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # observe the range split itself
    try:
        parts = (df.repartition(8).sort("file_ord", "row_idx").select("file_ord", F.spark_partition_id().alias("p"))
                 .where("file_ord = 1").select("p").distinct().count())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts >= 2
