"""Repeated passages against a plain version over strings, and planted ones."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetfold.llm import substring_dedup as SD
from sheetfold.llm.words import words_of


def _units(text):
    """Units as (words, start, end, line number), cut by the library's cut points."""
    out, words, run = [], [], 0
    offset = 0
    for number, line in enumerate((text or "").split("\n")):
        found = list(brute.WORD.finditer(line))
        unit, since = [], 99
        for i, m in enumerate(found):
            before = words[-1] if words else None
            words.append(brute.lower_az(m.group()))
            run = run + 1 if words[-1] == before else 0
            raw = run % SD.RUN == SD.RUN - 1 or SD.mix64(words_of([m.group().encode()]).digests)[0] % np.uint64(SD.CUT) == 0
            unit.append(m)
            if raw and since > 2 or i == len(found) - 1:
                out.append((tuple(brute.lower_az(x.group()) for x in unit), offset + unit[0].start(), offset + unit[-1].end(), number))
                unit = []
            since = 1 if raw else since + 1
        offset += len(line) + 1
    return out


def brute_spans(rows):
    """A run goes from a unit to the next where their pair occurs earlier; alone a unit counts from ``MIN_LINE`` words on."""
    docs = [(d, _units(t)) for d, t in rows]
    rank = lambda d: SD.LAST if d is None else d

    def keys(us):
        words = [u[0] for u in us]
        return [w if len(w) >= SD.MIN_LINE else None for w in words], [*zip(words, words[1:])]
    owners = {}
    for d, us in docs:
        for x in [x for part in keys(us) for x in part if x]:
            owners[x] = min(owners.get(x, rank(d)), rank(d))
    spans = []
    for d, us in docs:
        def marks(found):
            seen, out = set(), []
            for x in found:
                out.append(-2 if x is None else owners[x] if owners[x] < rank(d) else None if x in seen else -2)
                seen.add(x)
            return out
        alone, linked = map(marks, keys(us))
        linked.append(-2)
        size = [len(u[0]) for u in us]
        i = 0
        while i < len(us):
            if alone[i] == -2 and linked[i] == -2:
                i += 1
                continue
            j = i
            while linked[j] != -2:
                j += 1
            j += 1
            owner = [linked[min(k, j - 2)] if j > i + 1 else alone[i] for k in range(i, j)]
            if sum(size[i:j]) >= SD.MIN_RUN:
                spans.append((d, us[i][1], us[j - 1][2], sum(size[i:j]), owner[0]))
            else:
                for number in sorted({u[3] for u in us[i:j]}):
                    whole = [k for k, u in enumerate(us) if u[3] == number]
                    words = sum(size[k] for k in whole)
                    if i <= whole[0] and whole[-1] < j and words >= SD.MIN_LINE:
                        spans.append((d, us[whole[0]][1], us[whole[-1]][2], words, owner[whole[0] - i]))
            i = j
    return sorted(spans, key=str)


@pytest.fixture(scope="module")
def planted():
    r = random.Random(4)
    vocabulary = ["é%dx" % i if i % 5 == 0 else "w%d" % i for i in range(3000)]

    def prose(n):
        return "".join(r.choice(vocabulary) + (r.choice([". ", "\n"]) if r.random() < 0.1 else " ") for _ in range(n))
    passage = [prose(60) for _ in range(6)]
    line = "one very common line of text"
    rows = []
    for i in range(240):
        text = prose(r.randint(20, 200))
        if i % 4 == 0:
            text += r.choice(passage).upper() + prose(40)
        if i % 3 == 0:
            text += "\n" + line + "\n" + prose(5)
        rows.append((i * 3, text))
    rows += [(9001, rows[1][1]), (9002, None), (9003, ""), (9004, " \n "), (None, rows[2][1]), (9005, "in " * 500),
             (9006, "unique tail " + "\n".join(["again and again and again"] * 20)), (9006, rows[4][1]), (9007, "z" * 200000),
             (9008, "x " + "tior, " * 77), (9009, "y " + "tior, " * 90), (9010, "tior, " * 60 + "\n" + "tior, " * 5)]
    return rows, passage


def test_spans_equal_the_plain_version(spark, planted):
    rows, _ = planted
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cuts", F.lit(1)).withColumn("digest", F.lit("a"))
    got = sorted(((x.doc_id, x.start, x.end, x.n_words, x.first_doc) for x in SD.removed_spans(df.repartition(6)).collect()), key=str)
    assert got == brute_spans(rows)


def test_planted_passages_go_once_and_clean_texts_stay(spark, planted):
    rows, passage = planted
    df = spark.createDataFrame([(d, t, len(t or "")) for d, t in rows], "doc_id long, text string, n_chars long")
    out = SD.substring_dedup(df)
    assert out.columns == df.columns
    new = {x.doc_id: x for x in out.where("doc_id < 9000").collect()}
    assert out.count() == len(rows)
    for p in passage:
        having = [d for d, t in rows if t and d is not None and d < 9000 and p.upper() in t]
        words = brute.WORD.findall(p.upper())
        assert p.upper() in new[having[0]].text
        for d in having[1:]:
            left = " ".join(brute.WORD.findall(new[d].text))
            assert " ".join(words[20:40]) not in left
    for i, (d, t) in enumerate(rows[:240]):
        if i % 4 and i % 3:
            assert new[d].text == t
        assert new[d].n_chars == len(new[d].text)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert SD.removed_spans(df).count() == 0 and SD.substring_dedup(df).count() == 0


def test_common_phrases_of_unrelated_documents_stay(spark):
    r = random.Random(6)
    phrases = []
    while len(phrases) < 12:  # each one unit, wherever it stands
        words = ["p%d" % r.randrange(10 ** 6) for _ in range(5)]
        cuts = SD.mix64(words_of([" ".join(words).encode()]).digests) % np.uint64(SD.CUT) == 0
        if cuts[-1] and not cuts[:-1].any():
            phrases.append(" ".join(words))
    rows = [(i, p) for i, p in enumerate(phrases)]
    rows += [(100, "\n".join(" ".join(phrases[i:i + 6]) for i in (0, 6))), (101, " ".join(phrases[3:9]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(x.doc_id, x.start, x.n_words, x.first_doc) for x in SD.removed_spans(df).collect()]
    assert got == [(101, 0, 30, 100)]  # 100 repeats every phrase, but no two of them in their order


def test_first_doc_holds_the_run(spark, planted):
    rows, _ = planted
    df = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(reversed(rows))  # of rows that share an id the first
    plain = lambda t: " ".join(brute.WORD.findall(brute.lower_az(t)))
    for x in SD.removed_spans(df).where("first_doc < 9000 and (doc_id < 9000 or doc_id is null)").collect():
        own = [u[0] for u in _units(texts[x.doc_id]) if x.start <= u[1] < x.end]
        assert " ".join(w for u in own[:2] for w in u) in plain(texts[x.first_doc])
