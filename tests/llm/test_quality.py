"""The co-trained classifier: held-out accuracy, odd rows, degenerate labels."""

import numpy as np
from pyspark.sql import functions as F

from sheetfold.llm import quality as Q

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    test = labels.where("doc_id % 4 = 1 and quality is not null")
    model = Q.train(docs, labels.where("doc_id % 4 <> 1"))
    got = Q.scores(docs, model).join(test, "doc_id").select("quality", "kept", "p_content", "p_metadata").toPandas()
    kept_good = got[got.quality == 1].kept.mean()
    kept_bad = got[got.quality == 0].kept.mean()
    print("kept of good, of bad:", kept_good, kept_bad, len(got))
    assert kept_good > 0.97 and kept_bad < 0.15


def test_filter_keeps_rows_and_columns(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = Q.train(docs, labels)
    docs = docs.withColumn("score", F.lit("x")).withColumn("y", F.array(F.lit(1), F.lit(None)))
    kept = {x.doc_id for x in Q.scores(docs, model).where("kept").collect()}
    out = Q.quality_filter(docs, model)
    assert out.schema == docs.schema
    assert {x.doc_id for x in out.collect()} == kept and 0.7 < len(kept) / docs.count() < 1


def test_odd_rows_and_empty_tables(spark):
    rows = [(1, None, None, None, None), (1, "", "s", "en", 0), (None, "x " * 100000, "s", None, -5), (2, "\x00é", "", "", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.train(docs, none)
    assert [x.score for x in Q.scores(docs, model).collect()] == [1.0] * 4
    real = Q.train(*(spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")))
    out = Q.scores(docs, real).collect()
    assert len(out) == 4 and all(0 <= x.score <= 1 for x in out)
    assert Q.scores(docs.limit(0), real).count() == 0 and Q.quality_filter(docs.limit(0), real).count() == 0


def test_the_driver_gets_the_classifier_only(spark, monkeypatch):
    """Features stay in the tasks, and the classifier is the one fitted to the same rows by hand."""
    r = np.random.default_rng(5)
    rows = [(int(i), " ".join(r.choice(["la", "casa", "#$%", "Verde", "x"], 20 + i % 7)), f"s{i % 3}", "es", int(i)) for i in range(300)]
    rows += [rows[7], (9, "otra cosa", None, None, None), (None, "sin id", "s1", "es", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    labels = spark.createDataFrame([(i, int("#$%" in rows[i][1][:20])) for i in range(0, 300, 2)] + [(9, 1), (None, 1)], "doc_id long, quality int")
    for name in ("toPandas", "toArrow"):
        monkeypatch.setattr(type(docs), name, lambda *a: (_ for _ in ()).throw(AssertionError("rows came to the driver")))
    model = Q.train(docs, labels)
    monkeypatch.undo()
    y = {i: float("#$%" in rows[i][1][:20]) for i in range(0, 300, 2)} | {9: 1.0}
    views = [Q.content_features([x[1].encode() for x in rows]), Q.metadata_features(*([x[i] for x in rows] for i in (2, 3, 4)))]
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0], i))
    known = [i for n, i in enumerate(order) if rows[i][0] in y and (not n or rows[order[n - 1]][0] != rows[i][0])]
    rest = [i for i in order if rows[i][0] not in y]
    hand = Q.CoTrained(views[0][known], views[1][known], np.array([y[rows[i][0]] for i in known]), views[0][rest], views[1][rest])
    assert model.constant is None and np.allclose(model.score(*views), hand.score(*views), rtol=0, atol=1e-9)


def test_views_teach_each_other():
    r = np.random.default_rng(1)
    y = (r.random(4000) < 0.5).astype(float)
    content, metadata = ((y[:, None] * 2 - 1) * 1.5 + r.normal(size=(4000, 3)) for _ in range(2))
    few = slice(0, 30)
    alone = Q.CoTrained(content[few], metadata[few], y[few], content[30:3000], metadata[30:3000], rounds=0)
    taught = Q.CoTrained(content[few], metadata[few], y[few], content[30:3000], metadata[30:3000])
    right = lambda m, j: ((m.score(content[3000:], metadata[3000:])[:, j] > 0.5) == y[3000:]).mean()
    assert right(taught, 2) >= right(alone, 2) - 0.01 and right(taught, 2) > 0.95


def test_exchange_teaches_what_the_labels_alone_do_not():
    # labelled documents all have the same metadata: only content, by its pseudo-labels, can teach that view
    r = np.random.default_rng(5)
    y = (r.random(6000) < 0.5).astype(float)
    content, metadata = ((y[:, None] * 2 - 1) * 1.5 + r.normal(size=(6000, 3)) for _ in range(2))
    metadata[:200] = 0.0
    content[4000:] = 0.0        # and the documents to judge show nothing but their metadata
    views = content[:200], metadata[:200], y[:200], content[200:4000], metadata[200:4000]
    right = lambda m: ((m.score(content[4000:], metadata[4000:])[:, 2] > 0.5) == y[4000:]).mean()
    alone, taught = right(Q.CoTrained(*views, rounds=0)), right(Q.CoTrained(*views))
    print("right alone, after the exchange:", alone, taught)
    assert alone < 0.6 and taught > 0.9
