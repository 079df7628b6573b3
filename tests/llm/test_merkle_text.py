"""Fingerprints against a plain Python version."""

import hashlib
import random

from pyspark.sql import functions as F

from sheetfold.llm import merkle_text as MT


def _pairs(rows):
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    return [(d, t, rows[(i + 1) % len(rows)][1]) for i, (d, t) in enumerate(rows)]


def _edited(t, n):
    k = len(t) // 2
    return t[:len(t) - k] + n[:k]


def test_next_texts_and_edits(spark):
    r = random.Random(3)
    rows = [(i * 7 - 300, "".join(r.choice("aé漢𝄞 \n") for _ in range(r.randint(0, 90)))) for i in range(300)]
    rows += [(None, "no id"), (5000, None), (5000, ""), (0, "x" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tree", F.lit(1)).withColumn("_range", F.lit(2))
    for ranges in (1, 2, 17, 400):
        got = [(x.doc_id, x.text, x.next_text) for x in MT.with_next_text(df, ranges).collect()]
        assert sorted(got, key=str) == sorted(_pairs(rows), key=str)
    for x in MT.fingerprints(df).collect():
        options = {_edited(t, n) for d, t, n in _pairs(rows) if d == x.doc_id}
        assert x.edited_text in options


def test_tree_roots_and_branches(spark):
    a = "one\ntwo\n\nthree\nfour"
    b = "one\nTWO\n\nthree\nfour\n\nfive"
    df = spark.createDataFrame([(a, b), (a, a), ("", None), (None, "\n"), ("a\n\n\nb", "a\n\nb")], "a string, b string")
    df = df.withColumn("x", MT.tree(F.col("a"))).withColumn("y", MT.tree(F.col("b")))
    got = df.select(MT.differing_paragraphs(F.col("x"), F.col("y")).alias("d"), MT.likeness(F.col("x"), F.col("y")).alias("l"),
                    F.col("x.root").alias("r")).collect()
    assert [tuple(e) for e in got[0].d] == [(0, 1), (2, 0)]
    assert got[1].d == [] and got[1].l == 1.0
    assert got[2].d == [] and got[2].l == 1.0
    assert got[3].d and got[3].l < 1 and got[4].d
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    node = lambda p: h("".join(h(p[i:i + MT.LEAF]) for i in range(0, len(p), MT.LEAF)))
    assert got[0].r == h(h(node("one") + node("two")) + h(node("three") + node("four")))


def test_likeness_is_read_from_the_fingerprints(spark):
    r = random.Random(8)
    rows = [("".join(r.choice("ab c\n") for _ in range(r.randint(0, 400))),) * 2 for _ in range(60)]
    rows = [(a, a if i % 4 == 0 else a[:len(a) // (i % 4)] + b[::-1]) for i, (a, b) in enumerate(rows)] + [("x" * 100_000, "x" * 99_999)]
    df = spark.createDataFrame(rows, "a string, b string").withColumn("x", MT.tree(F.col("a"))).withColumn("y", MT.tree(F.col("b")))
    out = df.select("a", "b", MT.serialised(F.col("x")).alias("p"), MT.serialised(F.col("y")).alias("q"),
                    MT.likeness(F.col("x"), F.col("y")).alias("near")).collect()
    for x in out:
        def leaves(print_):
            return {leaf for s in print_.split(":")[1].split("/") for p in s.split(";") for leaf in p.split(".")[1:]}
        own, other = leaves(x.p), leaves(x.q)
        dice = 2 * len(own & other) / (len(own) + len(other)) if own or other else 0.0
        assert x.near == (1.0 if x.a == x.b else min(dice, 0.999999)) and (x.p == x.q) == (x.a == x.b)


def test_empty_table(spark):
    assert MT.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0
