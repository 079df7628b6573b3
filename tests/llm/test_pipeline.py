"""The corpus pipeline against a plain version, stage by stage."""

import hashlib
import zlib
from collections import Counter

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_mixing import _targets
from test_substring_dedup import brute_spans
from tokenizers import Tokenizer

from sheetfold.llm.common import store

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in corpus_pipeline.STAGES:
        out.append(store(f(spark, out[-1], SF), name))
    return out


def _rows(df):
    return [(x.doc_id, x.text) for x in df.select("doc_id", "text").collect()]


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = stages[0].join(labels, "doc_id").join(stages[1].select("doc_id", F.lit(1).alias("stays")), "doc_id", "left")
    good = judged.groupBy("quality").agg(F.count("stays"), F.count("doc_id")).collect()
    for quality, stays, n in good:
        assert stays >= 0.97 * n if quality == 1 else stays <= 0.1 * n


def test_near_dedup(stages):
    want = sorted(d for d, n, c, kept in brute.near_groups(_rows(stages[1])) if kept)
    assert sorted(d for d, _ in _rows(stages[2])) == want


def test_substring_dedup(stages):
    before, after = dict(_rows(stages[2])), dict(_rows(stages[3]))
    spans = {}
    for d, start, end, _, _ in brute_spans(list(before.items())):
        spans.setdefault(d, []).append((start, end))
    assert before.keys() == after.keys()
    for d, text in before.items():
        kept, at = "", 0
        for start, end in sorted(spans.get(d, [])):
            kept, at = kept + text[at:start], end
        kept += text[at:]
        assert brute.WORD.findall(after[d]) == brute.WORD.findall(kept)
        assert (d in spans) == (after[d] != text)


def test_mixing(stages):
    rows = stages[3].select("doc_id", "text", "source").collect()
    size = {x.doc_id: len(brute.WORD.findall(x.text)) for x in rows}
    per_source = Counter()
    for x in rows:
        per_source[x.source] += size[x.doc_id]
    target = _targets(dict(per_source))
    copies = Counter(d for d, _ in _rows(stages[4]))
    for x in rows:
        rate = target[x.source] / per_source[x.source] if per_source[x.source] else 0.0
        u = int(hashlib.md5(f"17:{x.doc_id}".encode()).hexdigest()[:13], 16) / 16 ** 13
        assert copies[x.doc_id] == int(rate) + (u < rate - int(rate))


def test_packing(stages):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    want = Counter()
    for d, t in _rows(stages[4]):
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(d, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    out = stages[5].collect()
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32) for x in out) == want
    load = Counter()
    for x in out:
        load[x.sequence_id] += x.length
    assert max(load.values()) <= 2048 and len(load) <= -(-sum(load.values()) // 2048) + 1


def test_run_equals_its_stages(spark, stages):
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).select(key).collect())) == Counter(map(tuple, stages[5].select(key).collect()))


@pytest.mark.parametrize("stage", range(5))
def test_stages_take_odd_rows(spark, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long, node string, cuts int, mix_rate int"
    rows = [(1, None, None, None, None, "a", 1, 1), (None, "a b c d e f", "en", "s", 11, None, None, 2), (2, "", "en", "s", 0, "b", 2, 3),
            (2, "", "en", "s", 0, "b", 2, 3), (3, "word " * 60000, None, "t", 300000, "c", 3, 4), (3, "other text", "de", None, None, "d", 4, 5)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        out = corpus_pipeline.STAGES[stage][1](spark, docs, SF)
        assert stage == 4 or out.columns == docs.columns
        assert out.count() <= 3 * len(data) + 200 * (stage == 4)
        if not data:
            assert out.count() == 0
