"""Hierarchical packing: exact round trips, no padding, few cuts, balanced steps."""

import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sheetfold.llm import tier_packing as TP
from sheetfold.llm.tokens import Encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_tokenizer(plain):
    r = random.Random(3)
    parts = ["'s", "'", "''", "'ll", " ", "  ", "\n", "\t", "\xa0", "　", "a", "é", "é", "́", "漢", "1", "²", "!", "<|endoftext|>",
             "<|STARTOFTEXT|>", "<|startoftext|>", "\x1c", "\x85", "Don't", "\r\n", "𝄞", "​", "İ", "Σ", "ΑΣ", "ا", "word",
             "\x00", "\x0b", "\x0c", "ß", "ÜŁ", "ŉ", "Ÿ", "ſ", "J\u030c", "a,b.c", "x<|endoftext|>y."]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(5000)] + ["", " ", "x" * 3000, "ab cd " * 90000]
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    enc = Encoder(PATH, slots=64, most=500, added=True, spaces=False)
    assert [x.tolist() for x in enc.encode([t.encode() for t in texts])] == want


@pytest.mark.parametrize("seed", range(4))
def test_windows_are_exact(seed):
    r = np.random.default_rng(seed)
    lengths = np.clip(r.lognormal(5, 1.3, 3000).astype(int), 1, 9000).tolist()
    windows, left = TP.pack_run(lengths, [], TP.TIERS, False)
    assert all(sum(p.length for p in w) in TP.TIERS for w in windows)
    assert sum(p.length for p in left) < 2048
    seen = defaultdict(list)
    for w in [*windows, left]:
        for p in w:
            seen[p.doc].append((p.start, p.length))
    for doc, n in enumerate(lengths):
        at = 0
        for start, length in sorted(seen[doc]):
            assert start == at and length > 0
            at += length
        assert at == n
    # at most one document is cut for a window beyond the whole windows that long ones give
    assert sum(map(len, seen.values())) <= len(lengths) + len(windows) + 1
    assert {sum(p.length for p in w) for w in windows} == set(TP.TIERS)


def test_last_ids_are_powers_of_two():
    windows, left = TP.pack_run([700, 900, 3], [], TP.TIERS, True)
    sizes = [sum(p.length for p in w) for w in windows]
    assert not left and sum(sizes) == 1603 and all(s & (s - 1) == 0 for s in sizes)


def test_gaps_take_the_largest_document_that_fits():
    windows, _ = TP.pack_run([1900, 130, 140, 18], [], TP.TIERS, False)
    assert [p.length for p in windows[0]] == [1900, 140, 8]     # then 8 of the 130


def test_steps_are_balanced():
    r = np.random.default_rng(1)
    windows, _ = TP.pack_run(np.clip(r.lognormal(5, 1.3, 5000).astype(int), 1, 9000).tolist(), [], TP.TIERS, False)
    ids, cost = defaultdict(int), defaultdict(int)
    for w, g in zip(windows, TP.step_groups(windows)):
        ids[g] += sum(p.length for p in w)
        cost[g] += sum(p.length ** 2 for p in w)
    assert max(ids.values()) - min(ids.values()) <= 2048
    assert max(cost.values()) < 1.1 * min(cost.values())


def _check(rows, out, plain):
    want = defaultdict(list)
    for d, t in rows:
        want[d].append(plain.encode(t or "", add_special_tokens=False).ids + [1])
    got = defaultdict(list)
    for x in out:
        got[x.doc_id].append(x)
    assert got.keys() == want.keys()
    for d, pieces in got.items():
        if len(want[d]) == 1:
            ids = np.array(want[d][0], "<u4").tobytes()
            assert b"".join(bytes(x.ids) for x in sorted(pieces, key=lambda x: x.start)) == ids
            assert all(x.doc_tokens == len(want[d][0]) and len(x.ids) == 4 * x.length for x in pieces)
            assert all(bytes(x.ids) == ids[4 * x.start:4 * (x.start + x.length)] for x in pieces)
        else:
            assert sum(x.length for x in pieces) == sum(map(len, want[d]))
    sequences = defaultdict(list)
    for x in out:
        sequences[x.sequence_id].append((x.offset, x.length, x.tier))
    for members in sequences.values():
        at = 0
        for offset, length, _ in sorted(members):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0 and {t for _, _, t in members} == {at}
    return sequences


def test_rows_in_several_tasks_and_runs(spark, plain):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(["alpha", "beta", "x", "Ω"]) for _ in range(r.randint(0, 900)))) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "long " * 9000), (903, "a b"), (903, "a b"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x")).withColumn("ids", F.lit(0))
    out = TP.tier_pack(df.repartition(3), PATH, run_tokens=20_000).collect()
    sequences = _check(rows, out, plain)
    assert sum(t < 256 for members in sequences.values() for _, _, t in members) <= 3 * 40
    assert len({x.step_id for x in out}) >= 3


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert TP.tier_pack(df, PATH).count() == 0


def test_tiers_have_to_be_powers_of_two(spark):
    with pytest.raises(ValueError):
        TP.tier_pack(spark.createDataFrame([], "doc_id long, text string"), PATH, tiers=(2048, 1000))
