"""How filters interact: what each removes at each place of every order, per part of a corpus.

Every document becomes five bits, one per filter that it fails. Counts per part and bit pattern are
all that later steps need: a part's counts are reshaped to a tensor with an axis of two (pass,
fail) per filter, and any step of any order is a contraction of it: ``pass`` along the axes of the
filters before, ``fail`` along its own, ``all`` along the others.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetfold.llm.common import store
from sheetfold.operators.joins import sized_side

FILTERS = "ABCDE"
SPACES = r"[\x20\x09-\x0D]+"
#: What is counted of a bit pattern: documents, those of good quality, toxic ones.
MEASURES = ["n", "good", "toxic"]
PASS, FAIL, ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])


def own_failures(text: Column) -> list[Column]:
    """Whether a (non-null) text fails A (under 200 words), B (fewer than half of its words are
    distinct), C (over 2% of its characters are ``[A-Z]``), D (it holds any of ``#$%&*|``)."""
    def words_fail(words):
        return F.struct((F.size(words) < 200).alias("a"),
                        (100 * F.size(F.array_distinct(words)) < 50 * F.size(words)).alias("b"))
    words = F.array_remove(F.split(text, SPACES), "")
    both = F.element_at(F.transform(F.array(words), words_fail), 1)
    return [both["a"], both["b"], 100 * F.regexp_count(text, F.lit("[A-Z]")) > 2 * F.char_length(text),
            text.rlike(r"[#$%&*|]")]


def patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, pattern, n, good, toxic``: documents by the filters that they fail (bit ``i`` of
    ``pattern``: the filter ``i``), and those whose label says good or toxic.

    Texts meet by their SHA-256 only, in an aggregate that keeps the smallest id; only texts that
    several ids hold are joined back.
    """
    text = F.coalesce("text", F.lit(""))
    bits = sum((f.cast("int") * (1 << i) for i, f in enumerate(own_failures(text))), F.lit(0))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text, 256)).alias("digest"), bits.cast("tinyint").alias("bits"))
    slim = store(slim, "audit-documents")
    firsts = (slim.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("_last"))
              .where("first < _last").select("digest", "first"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marks = marks.where("doc_id is not null and (good = 1 or toxic = 1)")
    rows = slim.join(sized_side(firsts, checkpoint=True), "digest", "left").join(marks, "doc_id", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)).cast("int")
    return rows.groupBy("part", (F.col("bits") + 16 * copy).cast("int").alias("pattern")).agg(
        F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("good", "toxic")])


def contract(tensor: np.ndarray, selections: list[np.ndarray]) -> np.ndarray:
    """``tensor`` (measures, then one axis of two per filter) summed over the selected halves."""
    return np.einsum("mabcde,a,b,c,d,e->m", tensor, *selections)


def part_audit(tensor: np.ndarray) -> pd.DataFrame:
    """All orders' steps of one part, from its tensor."""
    n = len(FILTERS)
    known: dict = {}

    def count(passed: frozenset, failed: int | None) -> np.ndarray:
        """Measures of what passes all of ``passed`` and fails ``failed`` (None: whatever)."""
        key = (passed, failed)
        if key not in known:
            known[key] = contract(tensor, [PASS if i in passed else FAIL if i == failed else ALL for i in range(n)])
        return known[key]

    rows = []
    shapley = [0] * n
    for order in permutations(range(n)):
        for step, f in enumerate(order, 1):
            before = frozenset(order[:step - 1])
            removed = count(before, f)
            shapley[f] += int(removed[0])
            rows.append(("".join(FILTERS[i] for i in order), step, f, int(count(before | {f}, None)[0]), int(removed[0]),
                         int(count(frozenset(), f)[0] - removed[0]), int(count(frozenset(range(n)) - {f}, f)[0]),
                         int(removed[1]), int(removed[2])))
    out = pd.DataFrame(rows, columns=["filter_order", "step", "_f", "kept", "removed", "redundant", "unique_fails",
                                      "good_lost", "toxic_lost"])
    out["shapley"] = np.array(shapley, np.int64)[out.pop("_f")]
    return out


def _audit(rows: pd.DataFrame) -> pd.DataFrame:
    flat = np.zeros((len(MEASURES), 1 << len(FILTERS)), np.int64)
    flat[:, rows["pattern"].to_numpy()] = rows[MEASURES].to_numpy().T
    # bit 0 is the last axis of the reshaped tensor: turn the axes round
    tensor = flat.reshape(len(MEASURES), *[2] * len(FILTERS)).transpose(0, *range(len(FILTERS), 0, -1))
    out = part_audit(tensor)
    out.insert(0, "part", rows["part"].iloc[0])
    return out


RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part (``source``), order of the five filters and step: what is ``kept`` and ``removed``,
    ``redundant`` (fails the step's filter, removed before), ``unique_fails`` (fails this filter
    only), ``good_lost`` and ``toxic_lost`` (removed here, by ``labels``), ``shapley`` (its filter's
    removed, summed over all orders).

    Filters: A to D see :func:`own_failures`; E: the text is that of a smaller id, anywhere. Null
    texts are empty, a null source is the part ``''``; a null id is smaller than none and no id
    is smaller than it; rows that share an id and a text all pass or fail E alike. Labels count by id:
    one that says 1 among several is enough; labels without an id, or of no document, count for
    nothing. Steps that remove nothing have rows of zeros; an empty table gives no rows. Other
    columns are ignored. A part has 32 patterns at most, so a group is never large.
    """
    return patterns(docs, labels).groupBy("part").applyInPandas(_audit, RESULT)
