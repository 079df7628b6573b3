"""Near-duplicate groups against all pairs, and the pieces they are built of."""

import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from sheetfold.llm import near_dedup as ND
from sheetfold.llm import words as W
from sheetfold.llm.components import connected_components


def _edit(r, words, n):
    words = list(words)
    for _ in range(n):
        i = r.randrange(len(words))
        words[i:i + 1] = r.choice([[], ["new%d" % r.randrange(10 ** 6)], [words[i], "x%d" % r.randrange(10 ** 6)]])
    return words


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    vocabulary = ["w%d" % i for i in range(4000)]
    out, ids = [], iter(r.sample(range(10 ** 6), 4000))
    for _ in range(60):
        base = [r.choice(vocabulary) for _ in range(r.randint(3, 200))]
        for _ in range(r.choice([1, 1, 2, 6])):
            out.append((next(ids), " ".join(_edit(r, base, r.randint(0, max(1, len(base) // 18))))))
    base = [r.choice(vocabulary) for _ in range(120)]
    chain = base
    for _ in range(150):  # a long chain of small edits: far ends have little in common
        out.append((next(ids), "  ".join(chain).title()))
        chain = _edit(r, chain, 2)
    out += [(next(ids), " ".join(base)) for _ in range(200)]
    shared = [r.choice(vocabulary) for _ in range(80)]
    out += [(next(ids), " ".join(shared + [r.choice(vocabulary) for _ in range(r.randint(20, 90))])) for _ in range(80)]
    out += [(next(ids), t) for t in (None, None, "", " \t\n", "one", "One", "a b c d", "a b c d ", "a b c d e", "é " * 9,
                                     "É " * 9, "x y z", "A" * 100000, "long " * 30000 + "tail", "a\x00b c")]
    out += [(None, "null id text of six words"), (None, " ".join(base)), (out[0][0], out[0][1]), (out[5][0], "same id other text here ok")]
    return out


def test_groups_equal_all_pairs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit("x")).withColumn("kept", F.lit(1))
    got = sorted(((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in ND.near_groups(df.repartition(7)).collect()), key=str)
    assert got == brute.near_groups(rows)


def test_blocks_split_hot_buckets(spark, rows, monkeypatch):
    monkeypatch.setattr(ND, "BLOCK", 7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in ND.near_groups(df).collect()), key=str)
    assert got == brute.near_groups(rows)


def test_real_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(x.doc_id, x.text) for x in df.select("doc_id", "text").collect()]
    got = sorted(((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in ND.near_groups(df).collect()), key=str)
    assert got == brute.near_groups(rows)


def test_dedup_keeps_one_of_each_group(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("Near_ID", F.lit("x"))
    out = ND.near_dedup(df)
    assert out.columns == df.columns
    got = sorted((x.doc_id for x in out.collect()), key=str)
    # of a group the rows with its smallest id, and of those that share it one; texts without words all stay
    sets = [brute.shingles(t) for _, t in rows]
    alike = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    first = {}
    for (d, _), s, root in zip(rows, sets, brute.components(len(rows), alike)):
        if s and (root not in first or d is not None and (first[root] is None or d < first[root])):
            first[root] = d
    assert got == sorted([d for (d, _), s in zip(rows, sets) if not s] + list(first.values()), key=str)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert ND.near_groups(df).count() == 0 and ND.near_dedup(df).count() == 0


def test_words_equal_the_pattern():
    texts = ["Ab\tc\x0bD  é漢 x \x1c y", "", "\n", "z", " lead", "trail "]
    w = W.words_of([t.encode() for t in texts])
    for i, t in enumerate(texts):
        found = [bytes(w.buffer[a:b]).decode() for a, b in zip(w.starts[w.first[i]:w.first[i + 1]], w.ends[w.first[i]:w.first[i + 1]])]
        assert found == brute.WORD.findall(t)


def test_signature_estimates_similarity():
    r = np.random.default_rng(5)
    errors = []
    for _ in range(200):
        pool = W.mix64(r.integers(0, 1 << 62, 700).astype(np.uint64))
        a, b = pool[:600], pool[100:]
        errors.append((ND.signature(a) == ND.signature(b)).mean() - 500 / 700)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_pruning_is_monotone_and_safe():
    limits = ND.fewest_matches(0.75)
    assert list(limits) == sorted(limits) and len(limits) == ND.HASHES // ND.BATCH
    assert limits[-1] < 0.75 * ND.HASHES
    low, high = (np.zeros((1, ND.HASHES), np.uint16), np.arange(ND.HASHES, dtype=np.uint16)[None] < 0.8 * ND.HASHES)
    assert len(ND.passing(low, low, limits)) == 1 and len(ND.passing(low, 1 - low, limits)) == 0
    assert len(ND.passing(low, (1 - high).astype(np.uint16), limits)) == 1


def test_components(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 180)] + [(5, i) for i in range(300, 400)] + [(7, 7)]
    edges += [(r.randrange(1000, 1400), r.randrange(1000, 1400)) for _ in range(250)]
    r.shuffle(edges)
    got = {x.node: x.root for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    roots = brute.components(1400, edges)
    least = {}
    for i, x in enumerate(roots):
        least.setdefault(x, i)
    assert got == {n: least[roots[n]] for e in edges if e[0] != e[1] for n in e}


def test_dedup_keeps_unlike_texts_that_share_an_id(spark):
    texts = [" ".join("w%d_%d" % (i, j) for j in range(30)) for i in range(6)]
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[1].upper()), (1, texts[1]), (None, texts[2]), (None, texts[3]), (None, texts[3]),
            (None, None), (None, None), (4, texts[4]), (5, texts[4]), (5, texts[5])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("near_root", F.lit("x"))
    out = ND.near_dedup(df)
    assert out.columns == df.columns
    got = sorted(((x.doc_id, x.text and x.text.lower()) for x in out.collect()), key=str)
    assert got == sorted([(1, texts[0]), (1, texts[1]), (None, texts[2]), (None, texts[3]), (None, None), (None, None),
                          (4, texts[4]), (5, texts[5])], key=str)


def dropped(similarity, limits):
    """The probability that a pair is dropped at one of all looks: a dynamic programme over its matches."""
    step = np.array([math.comb(ND.BATCH, j) * similarity ** j * (1 - similarity) ** (ND.BATCH - j) for j in range(ND.BATCH + 1)])
    alive, gone = np.ones(1), 0.0
    for least in limits:
        alive = np.convolve(alive, step)
        gone += alive[:least].sum()
        alive[:least] = 0
    return gone


def test_all_looks_together_keep_the_miss():
    limits = ND.fewest_matches(0.75)
    assert dropped(0.75, limits) <= ND.MISS and dropped(0.76, limits) <= dropped(0.75, limits)
    assert dropped(0.3, limits) > 0.999


def thue_morse(n):
    t = "a"
    while len(t) < n:
        t += t.translate(str.maketrans("ab", "ba"))
    return t, t.translate(str.maketrans("ab", "ba"))


def test_patterned_words_keep_apart(spark):
    a, b = thue_morse(1024)
    assert len(set(W.words_of([a.encode(), b.encode()]).digests.tolist())) == 2
    words = ["\x00", "\x00\x00", "a", "a\x00", "A\x00b", "x" * 8, "x" * 16, "x" * 17, "xxxxxxxxy", "yxxxxxxxx", *thue_morse(4096)]
    assert len(set(W.words_of([w.encode() for w in words]).digests.tolist())) == len(words)
    out = ND.near_groups(spark.createDataFrame([(1, a), (2, b)], "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.component_id) for x in out) == [(1, 1), (2, 2)]


def _bucket(r, n, edits):
    """Rows as one block holds them: near copies of one text, all in components of their own."""
    base = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(n):
        t = list(base)
        for i in r.sample(range(150), edits):
            t[i] = f"x{r.randrange(10 ** 9)}"
        texts.append(" ".join(t).encode())
    return W.shingle_sets(W.words_of(texts))


@pytest.mark.parametrize("edits", [2, 4, 5])
def test_links_of_a_block_are_fewer_than_its_members(edits):
    import pyarrow as pa

    for n in (50, 100, 200):
        sets = _bucket(random.Random(n), n, edits)
        sig = [ND.signature(s)[:ND.BANDS * ND.ROWS] for s in sets]
        out = []
        for band in range(ND.BANDS):        # every bucket of every band
            by = {}
            for i in range(n):
                by.setdefault(sig[i][band * ND.ROWS:(band + 1) * ND.ROWS].tobytes(), []).append(i)
            rows = [(k, i) for k, ids in enumerate(by.values()) for i in ids]
            batch = pa.RecordBatch.from_pydict({
                "part": [k for k, _ in rows], "block": [0] * len(rows), "single": [True] * len(rows), "band": [band] * len(rows),
                "node": [i for _, i in rows], "root": [i for _, i in rows], "n_shingles": [len(sets[i]) for _, i in rows],
                "sig": [sig[i].tobytes() for _, i in rows], "shingles": [sets[i].tobytes() for _, i in rows]})
            links = [(a, b) for x in ND._compare_blocks(75)(iter([batch])) for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist())]
            assert len(links) <= len(rows) - len(by)
            out += links
        want = [(i, j) for i in range(n) for j in range(i) if ND.alike(sets[i], sets[j], 75)]
        got, full = brute.components(n, out), brute.components(n, want)
        assert len(set(zip(got, full))) == len(set(got)) == len(set(full))
