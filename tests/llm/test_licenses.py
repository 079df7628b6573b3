"""License scans: planted notices, edited ones, and the alignment against a plain one."""

import random

from pyspark.sql import functions as F

from sheetfold.llm import licenses as L


def _lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_patience_is_a_common_subsequence():
    r = random.Random(3)
    for _ in range(300):
        a = [r.randrange(40) for _ in range(r.randint(0, 40))]
        b = [x for x in a if r.random() < 0.8] + [r.randrange(40) for _ in range(r.randint(0, 5))]
        pairs = L.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
        assert len(pairs) <= _lcs(a, b)
    unique = list(range(50))
    r.shuffle(unique)
    assert len(L.patience(unique, sorted(unique))) <= _lcs(unique, sorted(unique))
    assert L.patience(unique, unique) == [(i, i) for i in range(50)]


def test_longest_increasing_is_longest():
    r = random.Random(1)
    for _ in range(200):
        seconds = r.sample(range(100), r.randint(0, 30))
        pairs = list(enumerate(seconds))
        got = L._longest_increasing(pairs)
        assert [q for _, q in got] == sorted(q for _, q in got)
        assert len(got) == _lcs(seconds, sorted(seconds))


def test_planted_notices(spark):
    r = random.Random(8)
    rows, want = [], set()
    for i in range(120):
        prose = " ".join(r.choice(["the", "license", "under", "é", "version", "of", "2.0", "w%d" % r.randrange(900)]) for _ in range(r.randint(0, 400)))
        if i % 3 == 0:
            name = r.choice(L.Templates(L.TEMPLATES).names)
            words = L.TEMPLATES[name].split()
            if len(words) > 40:  # an edit here and there
                words[7] = "changed"
                words.insert(20, "inserted words")
            text = (" \n" if r.random() < 0.5 else " ").join(words)
            prose += " zz.\n" + (text.upper() if i % 2 else text) + "\nqq " + prose
            want.add((i, name))
        rows.append((i, prose))
    rows += [(900, None), (901, ""), (902, "mit " * 40000), (903, "Released under the MIT License."), (903, "Released under the MIT License.")]
    want |= {(903, "MIT")}
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit(1))
    out = L.license_scan(df).collect()
    got = {(x.doc_id, x.license) for x in out}
    assert want <= got
    assert len([x for x in out if x.doc_id == 903]) == 2
    assert len(got - want) <= 2  # prose made of a notice's words
    texts = dict(rows)
    for x in out:
        if x.license == "MIT-text":
            assert " ".join(texts[x.doc_id][x.start:x.end].lower().split()).endswith("portions of the software.") and x.coverage > 0.9


def test_empty_table(spark):
    assert L.license_scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_license_lines_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lines = docs.where("text rlike 'Released under the MIT License|Licensed under CC BY-NC 4.0|GNU General Public License, version 3|Licensed under the Apache License, Version 2.0'")
    want = {x.doc_id for x in lines.select("doc_id").collect()}
    assert want == {x.doc_id for x in L.license_scan(docs).collect()}


def _names(text):
    return [x[1] for x in L.Templates(L.TEMPLATES | L.BODIES, L.PHRASES).scan([text.encode()], L.COVERAGE)]


def test_neighbouring_licenses_are_told_apart():
    for text in ("Released under the BSD License.", "Licensed under CC BY 4.0.", "Licensed under CC BY-SA 4.0.",
                 "This work is licensed under the GNU General Public License, version 2.",
                 "This work is licensed under the GNU Lesser General Public License, version 3.",
                 "Licensed under the Apache License, Version 1.1.",
                 L.TEMPLATES["GPL-3.0-notice"].replace("version 3", "version 2"),
                 L.TEMPLATES["GPL-3.0-notice"].replace("GNU General", "GNU Lesser General")):
        assert _names("some words " + text + " more words") == []
    for name, phrases in L.PHRASES.items():
        assert phrases and all(L.Templates({name: (L.TEMPLATES | L.BODIES)[name]}, L.PHRASES).phrases[0]), name


def test_every_template_and_body_is_found_as_itself():
    for name, text in (L.TEMPLATES | L.BODIES).items():
        assert _names("some words before. " + text + " zz after") == [name]
    agpl = L.BODIES["GPL-3.0-body"].replace("GNU GENERAL PUBLIC LICENSE", "GNU AFFERO GENERAL PUBLIC LICENSE")
    assert "GPL-3.0-body" not in _names(agpl)
