"""Language identification: held-out accuracy, spans of mixed texts, Viterbi against all paths."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from sheetfold.llm import language_id as LI


def test_viterbi_is_the_best_path():
    r = np.random.default_rng(3)
    lengths = [0, 1, 5, 3, 0, 6]
    first = np.concatenate([[0], np.cumsum(lengths)])
    scores = r.normal(0, 3, (sum(lengths), 3)).astype(np.float32)
    path = LI.viterbi(scores, first, 2.5)
    for a, b in zip(first, first[1:]):
        def total(p):
            return sum(scores[a + i, x] for i, x in enumerate(p)) - 2.5 * sum(x != y for x, y in zip(p, p[1:]))
        best = max(itertools.product(range(3), repeat=b - a), key=total)
        assert abs(total(best) - total(path[a:b])) < 1e-3


def test_held_out_accuracy_and_undefined(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = LI.train(docs.where(~LI.held_out(F.col("doc_id"))))
    got = LI.identify(docs.where(LI.held_out(F.col("doc_id"))), model).join(docs.select("doc_id", "lang"), "doc_id")
    accuracy = got.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    print("accuracy", accuracy)
    assert accuracy > 0.93
    odd = spark.createDataFrame([(1, None), (2, ""), (3, " 12 !\n"), (4, "the " * 50000), (5, "Ω" * 9), (5, "漢字")], "doc_id long, text string")
    out = LI.identify(odd.withColumn("score", F.lit(1)).withColumn("lang_pred", F.lit("x")), model, spans=True).collect()
    by = {(x.doc_id, x.lang_pred == "und") for x in out}
    assert {(1, True), (2, True), (3, True), (4, False)} <= by and len(out) == 6
    assert all(0 <= x.score <= 1 for x in out)
    assert [x.score for x in out if x.lang_pred == "und"] == [0.0, 0.0, 0.0]


def test_spans_of_a_mixed_text(spark):
    english = "the quick brown fox jumps over the lazy dog and then they went with that other thing "
    german = "der schnelle braune Fuchs springt über den faulen Hund und dann gingen sie mit jenem nach Hause "
    russian = "быстрая коричневая лиса прыгает через ленивую собаку "
    rows = [(i, t * 3, lang) for i in range(20) for t, lang in ((english, "en"), (german, "de"), (russian, "ru"))]
    model = LI.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    mixed = english + german + "лиса " + english
    out = LI.identify(spark.createDataFrame([(1, mixed)], "doc_id long, text string"), model, spans=True).first()
    assert [s.lang for s in out.spans] == ["en", "de", "ru", "en"]
    assert mixed[out.spans[2].start:out.spans[2].end] == "лиса"
    assert out.lang_pred == "en" and 0.5 < out.score < 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    model = LI.train(none)
    assert LI.identify(none, model).count() == 0
    assert LI.identify(spark.createDataFrame([(1, "word")], "doc_id long, text string"), model).first().lang_pred == "und"
