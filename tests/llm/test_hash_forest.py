"""Nearest neighbours against brute force: exact on small tables, recall on a larger one."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetfold.llm import hash_forest as HF

SCHEMA = "vec_id long, embedding array<double>"


def _brute(rows, every, k):
    good = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and len(v) == 4
            and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = []
    for q, x in good:
        if q % every == 0:
            d = sorted((float(np.sqrt(((np.array(y) - np.array(x)) ** 2).sum())), i) for i, y in good if i != q)[:k]
            out += [(q, r, i, round(s, 9)) for r, (s, i) in enumerate(d, 1)]
    return sorted(out)


def _got(df):
    return sorted((x.query_id, x.rank, x.vec_id, round(x.score, 9)) for x in df.collect())


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(2)
    out = [(i, r.normal(size=4).tolist()) for i in range(0, 900, 3)]
    same = r.normal(size=4).tolist()
    out += [(i, same) for i in range(10000, 10060)] + [(10000, same), (0, out[0][1])]
    out += [(i, [float(i % 5), 0.0, 0.0, 1.0]) for i in range(20000, 20050)]
    nan, inf = float("nan"), float("inf")
    out += [(50, None), (100, [0.0] * 4), (150, [1.0, None, 0.0, 0.0]), (200, [nan, 0.0, 0.0, 1.0]), (250, [inf, 0.0, 0.0, 1.0]),
            (None, [1.0] * 4), (350, [1.0, 2.0]), (400, []), (450, [1e200, 0.0, 0.0, 0.0]), (500, [-0.0, 0.0, 0.0, 2.0]), (550, [0.0, 0.0, 0.0, 2.0])]
    return out


def test_equal_to_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("class", F.lit("x")).withColumn("rank", F.lit(1))
    assert _got(HF.nearest_neighbours(df, every=50)) == _brute(rows, 50, 10)


def test_short_arrays_fall_back_to_all_vectors(spark, rows, monkeypatch):
    monkeypatch.setattr(HF, "ARRAY", 32)
    monkeypatch.setattr(HF, "BLOCK", 50)
    df = spark.createDataFrame(rows, SCHEMA)
    assert _got(HF.nearest_neighbours(df, every=50, trees=2)) == _brute(rows, 50, 10)


def test_fewer_candidates_than_k_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (7, [0.0, 1.0]), (100, [3.0, 3.0])], SCHEMA)
    assert [x[:3] for x in _got(HF.nearest_neighbours(df))] == [(0, 1, 7), (0, 2, 100), (100, 1, 0), (100, 2, 7)]
    assert HF.nearest_neighbours(df.limit(0)).count() == 0
    assert HF.nearest_neighbours(spark.createDataFrame([(0, None)], SCHEMA)).count() == 0


@pytest.mark.parametrize("n", [8000, 16000])
def test_recall(spark, n):
    v = np.random.default_rng(n).normal(size=(n, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    got = {}
    for x in HF.nearest_neighbours(spark.createDataFrame(list(enumerate(v.tolist())), SCHEMA), candidates=4000).collect():
        got.setdefault(x.query_id, set()).add(x.vec_id)
    hits = 0
    for q in range(0, n, 100):
        far = ((v - v[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hits += len(got[q] & set(np.argsort(far, kind="stable")[:10].tolist()))
    recall = hits / (10 * len(got))
    print("recall", recall)
    assert recall >= 0.9


def test_recall_holds_whatever_the_least_number_of_candidates(spark):
    r = np.random.default_rng(7)
    v = r.normal(size=(12000, 64))
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    hits = 0
    got = {}
    for x in HF.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), candidates=600).collect():
        got.setdefault(x.query_id, set()).add(x.vec_id)
    for q in range(0, 12000, 100):
        far = ((v - v[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        hits += len(got[q] & set(np.argsort(far)[:10].tolist()))
    assert hits / 1200 >= 0.85
