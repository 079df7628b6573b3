"""Pieces and packing: exact round trips, rules and tightness."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sheetfold.llm import packing as PK
from sheetfold.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_ids_equal_the_tokenizer(plain):
    r = random.Random(1)
    parts = ["'s", "'", "''", "'ll", " ", "  ", "\n", "\t", "\xa0", "　", "a", "é", "漢", "1", "²", "!", "<|endoftext|>", "\x1c",
             "\x85", " ", "don't", "\r\n", "𝄞", "​", "İ", "ا", "word", "\x00"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 14))) for _ in range(5000)] + ["", " ", "x" * 3000]
    enc = Encoder(PATH, slots=64, most=500)  # places are taken over and forgotten
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in enc.encode([t.encode() for t in texts])] == want
    assert enc.encode([None, b"a"])[0].tolist() == []


def test_two_pieces_replace_the_smallest():
    # 60 then 30 leave a gap of 10; 25 and 15 fill the 40 that the 30 gives up
    assert sorted(map(sorted, PK.best_two_fit(np.array([60, 30, 25, 15]), 100))) == [[0, 2, 3], [1]]


@pytest.mark.parametrize("seed", range(4))
def test_bins_are_whole_and_tight(seed):
    r = np.random.default_rng(seed)
    lengths = np.clip(r.lognormal(5, 1.2, 5000).astype(int), 1, 2048)
    bins = PK.best_two_fit(lengths)
    assert sorted(i for b in bins for i in b) == list(range(5000))
    assert all(lengths[b].sum() <= 2048 for b in bins)
    assert len(bins) <= -(-lengths.sum() // 2048) + 1


def test_query_rows(spark, plain):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice(["alpha", "beta", "x", "Ω"]) for _ in range(r.randint(0, 900)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "long " * 9000), (903, "a b"), (903, "a b"), (None, "no id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("piece", F.lit("x")).withColumn("number", F.lit(0))
    pieces = PK.token_pieces(df, PATH)
    out = PK.pack(pieces.withColumn("crc", F.crc32("ids")), group=40).collect()
    want = []
    for d, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        want += [(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(((x.doc_id, x.piece, x.start, x.length, x.crc) for x in out), key=str) == sorted(want, key=str)
    bins = defaultdict(list)
    for x in out:
        bins[x.sequence_id].append((x.offset, x.length))
    for members in bins.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert PK.pack(PK.token_pieces(df, PATH)).count() == 0


def test_added_tokens_get_their_ids(spark):
    unchanged = Tokenizer.from_file(PATH)
    r = random.Random(9)
    parts = ["<|endoftext|>", "<|endoftext|>", " ", "\n", "word", "<|", "|>", "é", "\xa0", "1", "endoftext"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(3000)]
    want = [e.ids for e in unchanged.encode_batch(texts, add_special_tokens=False)]
    assert any(50256 in x for x in want)
    enc = Encoder(PATH, slots=64, most=500, added=True)
    assert [x.tolist() for x in enc.encode([t.encode() for t in texts])] == want
    rows = list(enumerate(["a <|endoftext|> b", "<|endoftext|>", "plain"]))
    out = PK.token_pieces(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    ids = {d: unchanged.encode(t, add_special_tokens=False).ids + [0] for d, t in rows}
    assert {x.doc_id: bytes(x.ids) for x in out} == {d: np.array(x, "<u4").tobytes() for d, x in ids.items()}
