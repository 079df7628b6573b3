"""The fixity audit against a comparison of all records."""

import hashlib
import random

from pyspark.sql import functions as F

from sheetfold.llm import warc_fixity as WF


def _records(r, archives):
    rows = []
    for a in range(archives):
        at = 0
        for _ in range(r.randint(1, 60)):
            body = bytes(r.randrange(256) for _ in range(r.choice([0, 5, 300, 9000])))
            rows.append((f"a{a}.warc", at, body))
            at += max(1, len(body)) + r.choice([0, 0, 70000, 5_000_000])
    return rows


def _audit(spark, first, second):
    frames = [spark.createDataFrame(x, "archive string, offset long, record binary").withColumn("digest", F.lit(1)).withColumn("place", F.lit(2))
              for x in (first, second)]
    return sorted((x.archive, x.offset, x.status, x.first_digest, x.second_digest) for x in WF.fixity_audit(*frames).collect())


def _brute(first, second):
    a, b = ({(x, o): hashlib.sha256(r or b"").hexdigest() for x, o, r in side if x is not None and o is not None} for side in (first, second))
    status = lambda k: "missing" if k not in b else "extra" if k not in a else "altered"
    return sorted((*k, status(k), a.get(k), b.get(k)) for k in a.keys() | b.keys() if a.get(k) != b.get(k))


def test_damage_is_located(spark):
    r = random.Random(6)
    first = _records(r, 12) + [("null.warc", 0, None), (None, 1, b"x"), ("a0.warc", None, b"x")]
    second = []
    for i, (a, o, rec) in enumerate(first):
        if i % 29 == 3:
            continue
        second.append((a, o, rec[:-1] + b"?" if rec and i % 31 == 5 else rec))
    second += [("new.warc", 7, b"extra"), ("a1.warc", 900_000_000_000, b"far away"), second[0], second[0]]
    got = [(a, o, s, x, y) for a, o, s, x, y in _audit(spark, first, second)]
    assert got == _brute(first, second)


def test_equal_and_empty_replicas(spark):
    rows = _records(random.Random(2), 3)
    assert _audit(spark, rows, list(reversed(rows))) == []
    assert _audit(spark, [], []) == []
    assert len(_audit(spark, rows, [])) == len(rows)


def test_equal_branches_are_not_descended(spark):
    rows = [("a", i * 40_000, b"x%d" % i) for i in range(500)]
    other = [(a, o, b"y" if o == 40_000 * 77 else r) for a, o, r in rows]
    make = lambda x: WF.merkle_tree(WF.record_digests(spark.createDataFrame(x, "archive string, offset long, record binary")))
    one, two = make(rows), make(other)
    found = None
    for p, q in zip(reversed(one), reversed(two)):
        found = WF._unequal(p, q, found)
        assert found.count() == 1
