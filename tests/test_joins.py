"""Joins against sides beyond the broadcast bound."""

import pytest
from pyspark.sql import functions as F

from sheetfold.operators.joins import materialize, sized_side


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_a_stored_side_beyond_the_bound_is_never_broadcast(spark, how):
    """Its files are small, being compressed: Spark alone would broadcast it."""
    side = materialize(spark.range(3000).select((F.col("id") % 2500).alias("k"), F.lit("x" * 200).alias("v")))
    big = materialize(spark.range(9000).select((F.col("id") % 4000).alias("k"), "id"))
    joined, free = big.join(sized_side(side, max_rows=2999), "k", how), big.join(sized_side(side, max_rows=3000), "k", how)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(free) and "Broadcast" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, free.collect()), key=str) != []
