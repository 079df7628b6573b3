"""The mix: its rounds, its plan and its emitted rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from sheetfold.llm import mixing as MX


def _targets(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {n: weights[i % 3] for i, n in enumerate(names)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        rest = total - sum(2 * sizes[n] for n in capped)
        left = sum(w[n] for n in names if n not in capped)
        more = {n for n in names if n not in capped and w[n] * rest / left > 2 * sizes[n]}
        if not more:
            return {n: 2.0 * sizes[n] if n in capped else w[n] * rest / left for n in names}
        capped |= more


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 5000, "c": 10}, {"a": 0, None: 7}, {"z": 3, "Z": 300, "é": 1000, None: 40, "": 9}, {"only": 11}])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in MX.source_targets(df).collect()}
    want = _targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)


def test_plan_and_mix_agree(spark):
    rows = [(i, "w " * (i % 13 + 1), "hot" if i % 3 else f"s{i % 9}") for i in range(4000)]
    rows += [(None, None, None), (1, "", "hot"), (7, "a b", "hot"), (7, "a b", "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("mix_rate", F.lit("x"))
    plan = MX.mix_plan(df).collect()
    assert len(plan) == len(rows)
    assert all(p.copies <= 2 for p in plan)
    out = MX.mix(df)
    assert out.columns == df.columns
    want = Counter()
    for p in plan:
        want[p.doc_id] += p.copies
    assert Counter(r.doc_id for r in out.collect()) == +want
    taken, target = Counter(), {}
    for p in plan:
        taken[p.source] += p.size * p.copies
        target[p.source] = p.target
    assert abs(taken["hot"] - target["hot"]) < 0.05 * target["hot"]
    assert sorted(map(str, MX.mix_plan(df.repartition(5)).collect())) == sorted(map(str, plan))


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert MX.mix_plan(df).count() == 0 and MX.mix(df).count() == 0
