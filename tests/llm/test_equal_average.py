"""Equal-average search against all entries; codes, errors and codebooks against a plain version."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetfold.llm import equal_average as EA


@pytest.mark.parametrize("seed", range(6))
def test_nearest_is_exact_and_ties_take_the_lowest(seed):
    r = np.random.default_rng(seed)
    spread = [2, 5, 40, 1000, 3, 10 ** 6][seed]
    entries = r.integers(-spread, spread + 1, (r.integers(1, 65), r.integers(1, 6)))
    parts = r.integers(-spread, spread + 1, (800, entries.shape[1]))
    index, best = EA.Codebook(entries).nearest(parts)
    d = ((parts[:, None] - entries) ** 2).sum(axis=2)
    assert (index == d.argmin(axis=1)).all() and (best == d.min(axis=1)).all()


def test_search_looks_at_few_entries():
    # sums spread over 6400: only entries near a part's own sum are looked at
    entries = np.arange(64)[:, None] * 25 + np.zeros((1, 4), np.int64)
    book = EA.Codebook(entries)
    looked = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            looked.append(np.size(at))
            return np.asarray(super().__getitem__(at))
    book.entries = book.entries.view(Counted)
    parts = np.random.default_rng(0).integers(0, 1600, (1000, 1)) + np.zeros((1, 4), np.int64)
    book.nearest(parts)
    assert sum(looked) <= 4 * 1000


def plain_codes(rows, rounds=2):
    kept = [(i, [math.floor(256 * float(x)) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(v) for _, v, _ in kept) // 16)
    kept = [(i, v + [0] * (16 * width - len(v)), lab, tuple(v)) for i, v, lab in kept]
    first = sorted(kept, key=lambda k: (k[0] is None, k[0] or 0, k[3]))[:64]
    books = [[k[1][p * width:(p + 1) * width] for k in first] for p in range(16)]

    def near(v, p):
        x = v[p * width:(p + 1) * width]
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        own = [[[] for _ in first] for _ in range(16)]
        for k in kept:
            for p in range(16):
                own[p][near(k[1], p)[1]].append(k[1][p * width:(p + 1) * width])
        books = [[[sum(c) // len(m) for c in zip(*m)] if m else books[p][j] for j, m in enumerate(own[p])] for p in range(16)]
    found = [[near(k[1], p) for p in range(16)] for k in kept]
    errors = [sum(d for d, _ in f) for f in found]
    by = {}
    for k, e in zip(kept, errors):
        by[k[2]] = by.get(k[2], 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((k[0], "".join(f"{j:02x}" for _, j in f), e, by[k[2]], digest) for k, f, e in zip(kept, found, errors)), key=str)


SCHEMA = "vec_id long, embedding array<float>, label int"


def _same(spark, rows, n=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(n).withColumn("code", F.lit("x")).withColumn("vector", F.lit(1)).withColumn("error", F.lit(1))
    assert sorted((tuple(x) for x in EA.vector_codes(df).collect()), key=str) == plain_codes(rows)


def _floats(r, n):
    return [float(np.float32(r.uniform(-1, 1))) for _ in range(n)]


def test_against_the_plain_version(spark):
    r = random.Random(1)
    rows = [(i, _floats(r, 32), r.choice([0, 1, None])) for i in range(150)]
    rows += [(3, _floats(r, 32), 1), (3, rows[3][1], 1), (None, _floats(r, 32), None), (None, None, 2), (900, None, 1),
             (-4, [float("nan")] + [0.0] * 31, 1), (-5, [None] + [0.0] * 31, 1), (-6, [float("inf")] * 32, 1),
             (-7, [0.0] * 32, 7), (-8, [-0.0] * 32, 7), (-9, _floats(r, 32), 7), (901, rows[0][1], 8), (902, [-3.5e4] * 32, 8)]
    r.shuffle(rows)
    _same(spark, rows)


def test_few_rows_and_unlike_lengths(spark):
    r = random.Random(2)
    _same(spark, [(1, _floats(r, 16), 0)])
    _same(spark, [(i, _floats(r, n), 0) for i, n in enumerate([20, 16, 0, 33, 7])])


def test_empty_tables(spark):
    assert EA.vector_codes(spark.createDataFrame([], SCHEMA)).count() == 0
    assert EA.vector_codes(spark.createDataFrame([(1, None, 0)], SCHEMA)).count() == 0
    only = EA.vector_codes(spark.createDataFrame([(1, [], 0)], SCHEMA)).collect()
    assert [tuple(x)[:4] for x in only] == [(1, "00" * 16, 0, 0)]


def test_too_large_components_are_refused(spark):
    with pytest.raises(Exception, match="would not fit"):
        EA.vector_codes(spark.createDataFrame([(1, [1e30] * 16, 0)], SCHEMA)).collect()
