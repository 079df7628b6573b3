"""Filter interactions against a plain simulation of all orders."""

import random
import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from sheetfold.llm import filter_audit as FA


def plain_failures(rows):
    out = []
    for d, t, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        out.append({f for f, bad in zip("ABCDE", (
            len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            bool(re.search(r"[#$%&*|]", t)),
            d is not None and any(e is not None and e < d and (u or "") == t for e, u, _ in rows))) if bad})
    return out


def plain_audit(rows, labels):
    fails = plain_failures(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    out, shapley = [], {}
    for part in {s or "" for _, _, s in rows}:
        own = [(d, f) for (d, _, s), f in zip(rows, fails) if (s or "") == part]
        for order in permutations("ABCDE"):
            there = own
            for step, x in enumerate(order, 1):
                gone = [(d, f) for d, f in there if x in f]
                there = [(d, f) for d, f in there if x not in f]
                shapley[part, x] = shapley.get((part, x), 0) + len(gone)
                out.append([part, "".join(order), step, len(there), len(gone), sum(x in f for _, f in own) - len(gone),
                            sum(f == {x} for _, f in own), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone)])
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def test_against_the_plain_version(spark):
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        k = r.choice([3, 150, 199, 200, 201, 260])
        t = r.choice([" ", "\n", "\t ", "\x0b"]).join(r.choice(vocabulary[:r.choice([60, 400])]) for _ in range(k))
        t += r.choice(["", " #", " 5%", " A", " ABCDEFGHIJKL" * 3, "\x85é", " Á"])
        rows.append((i, t, r.choice(["s", "t", None, ""])))
    rows += [(200 + i, r.choice(rows)[1], r.choice(["s", "u"])) for i in range(40)]
    rows += [(300, None, "s"), (301, "", "t"), (302, "   ", "t"), (None, rows[0][1], "s"), (None, rows[0][1], "s"),
             (303, "same", "u"), (303, "same", "u"), (303, "other", "u"), (302, "w " * 50_000, "u"), (-5, rows[1][1], "v")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(0, 310, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    docs = (spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
            .withColumn("part", F.lit(1)).withColumn("good", F.lit("x")).withColumn("digest", F.lit(None)))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit("x"))
    got = sorted(tuple(x) for x in FA.filter_audit(docs, marks).collect())
    assert got == plain_audit(rows, labels)


def test_contraction_selects_halves():
    r = np.random.default_rng(0)
    t = r.integers(0, 50, (3, 2, 2, 2, 2, 2))
    assert (FA.contract(t, [FA.PASS, FA.FAIL, FA.ALL, FA.ALL, FA.PASS]) == t[:, 0, 1, :, :, 0].sum(axis=(1, 2))).all()


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert FA.filter_audit(docs, labels).count() == 0
    one = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    rows = FA.filter_audit(one, labels).collect()
    assert len(rows) == 600 and sum(x.removed for x in rows) == 120
