"""Repeated passages: units of lines, hashed and grouped globally.

A text's units are its lines, and a line's words are cut further at content-defined points: after
a word whose digest is divisible by ``CUT``, or that ends ``RUN`` repeats of itself, unless another
such word lies among the two before it. A passage thus has the same units wherever it stands, also inside longer lines. Units are
normalised (case of A-Z and white space do not count) and hashed, and so is every pair of
neighbouring units; all documents' digests are grouped, the earliest occurrence by (document id,
position) stays and the others are marked. A run goes from a unit to the next only where their pair
is marked. Of these runs go those of at least ``MIN_RUN`` words, and of shorter ones the whole lines
of at least ``MIN_LINE`` words; offsets refer to the original text.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetfold.llm.common import free_name
from sheetfold.llm.words import Words, chunks, mix64, slices, words_of

CUT, RUN = 3, 8
#: Words of adjacent marked units, and of a marked whole line, from which they are removed.
MIN_RUN, MIN_LINE = 15, 5
#: The rank of a null id: after every other.
LAST = (1 << 63) - 1


class Units(NamedTuple):
    """Units of many texts: unit u holds the words ``begin[u]`` to ``end[u] - 1``."""

    begin: np.ndarray
    end: np.ndarray
    digests: np.ndarray
    line: np.ndarray   # a number that units of one line share
    first: np.ndarray  # first[d] .. first[d + 1]: the units of text d


def units_of(w: Words) -> Units:
    """The units of the words ``w``."""
    n = len(w.starts)
    if not n:
        none = np.zeros(0, np.int64)
        return Units(none, none, none.astype(np.uint64), none, np.zeros_like(w.first))
    breaks = np.cumsum(w.buffer == ord("\n"))[w.starts]  # line breaks before each word; every text ends with one
    last_of_line = np.append(breaks[1:] != breaks[:-1], True)
    raw = mix64(w.digests) % np.uint64(CUT) == 0
    fresh = np.append(True, w.digests[1:] != w.digests[:-1])  # a run of one word is cut at every RUN-th
    raw |= (np.arange(n) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1]) % RUN == RUN - 1
    near = np.zeros(n, bool)  # another such word among the two before in the line
    near[1:] |= raw[:-1] & (breaks[1:] == breaks[:-1])
    near[2:] |= raw[:-2] & (breaks[2:] == breaks[:-2])
    ends = np.flatnonzero(raw & ~near | last_of_line) + 1
    begins = np.concatenate([[0], ends[:-1]])
    # a sequence's digest: its words' digests weighted by the powers of an odd number
    place = np.arange(n) - np.repeat(begins, ends - begins)
    power = np.full(int((ends - begins).max()), np.uint64(0xD6E8FEB86659FD93))
    power[0] = 1
    total = np.add.reduceat(w.digests * np.multiply.accumulate(power)[place], begins)
    return Units(begins, ends, mix64(total + (ends - begins).astype(np.uint64)), breaks[begins], np.searchsorted(begins, w.first))


def pairs_of(digests: np.ndarray) -> np.ndarray:
    """Digests of each unit with the next one."""
    return mix64(mix64(digests[:-1] + np.uint64(1)) * np.uint64(0xA0761D6478BD642F) + digests[1:])


def _unit_rows(batches):
    """A row for each distinct pair of neighbouring units of each text and each distinct unit of at
    least ``MIN_LINE`` words (a smaller one goes only in a pair), and whether the text repeats it."""
    for batch in slices(batches):
        ids, keys, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
        for begin, some in chunks(texts):
            u = units_of(words_of(some))
            which, digests, again = [], [], []
            for d, (a, b) in enumerate(zip(u.first[:-1].tolist(), u.first[1:].tolist())):
                own = u.digests[a:b]
                alone = own[u.end[a:b] - u.begin[a:b] >= MIN_LINE]
                distinct, count = np.unique(np.concatenate([alone, pairs_of(own)]), return_counts=True)
                digests.append(distinct), again.append(count > 1), which.append(np.full(len(distinct), begin + d))
            rows = pa.array(np.concatenate(which))
            yield pa.RecordBatch.from_arrays(
                [ids.take(rows), keys.take(rows), pa.array(np.concatenate(digests).view(np.int64)), pa.array(np.concatenate(again))],
                names=["doc_id", "text_key", "digest", "again"])


def marked_units(docs: DataFrame) -> DataFrame:
    """``doc_id, text_key, units``: for each document that has any, its units and pairs that occur earlier,
    as ``array<struct<digest, owner>>``. ``owner`` is the earliest document's id if that is
    another one, and null where only repeats inside the document go.

    Occurrences rank by document id (null last) and position. Rows that share an id rank alike:
    neither gives way to the other. A digest's group is only ever reduced to its smallest and
    largest rank, and joined with that one row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                       F.col("text").cast("binary").alias("text")).where(F.col("text").isNotNull())
    units = rows.mapInArrow(_unit_rows, "doc_id long, text_key long, digest long, again boolean")
    rank = F.coalesce("doc_id", F.lit(LAST))
    repeated = (units.groupBy("digest").agg(F.min(rank).alias("owner"), F.max(rank).alias("_last"))
                .where("owner <> _last").select("digest", "owner"))
    owner = F.when(F.col("owner") < rank, F.col("owner"))
    return (units.join(repeated, "digest", "left").withColumn("owner", owner).where("owner is not null or again")
            .groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("digest", "owner")).alias("units")))


def _removed(w: Words, u: Units, d: int, owners: dict) -> list[tuple[int, int, int]]:
    """Of text ``d`` the removed runs of units, as (first unit, one past the last, owner). ``owners``
    has the marked digests; None stands for the text itself."""
    a, b = int(u.first[d]), int(u.first[d + 1])

    def marked(digests):
        seen, marks = set(), []
        for x in digests.view(np.int64).tolist():
            owner = owners.get(x, False)
            marks.append(False if owner is None and x not in seen else owner)
            seen.add(x)
        return marks
    marks, linked = marked(u.digests[a:b]), [*marked(pairs_of(u.digests[a:b])), False]
    size = (u.end[a:b] - u.begin[a:b]).tolist()
    line = u.line[a:b].tolist()
    out, i, n = [], 0, b - a
    while i < n:
        if linked[i] is False and marks[i] is False:
            i += 1
            continue
        j = i + 1
        while linked[j - 1] is not False:
            j += 1
        owner = [marks[i]] if j == i + 1 else [*linked[i:j - 1], linked[j - 2]]
        if sum(size[i:j]) >= MIN_RUN:
            out.append((a + i, a + j, owner[0]))
        else:
            p = i
            while p < j:  # whole lines inside the run
                q = p
                while q < n and line[q] == line[p]:
                    q += 1
                if q <= j and (p == 0 or line[p - 1] != line[p]) and sum(size[p:q]) >= MIN_LINE:
                    out.append((a + p, a + q, owner[p - i]))
                p = q
        i = j
    return out


def _cut(text: bytes, owners: dict) -> tuple[bytes, list[dict]]:
    """The text without its marked runs and lines, and these as spans in code points."""
    w = words_of([text])
    u = units_of(w)
    runs = _removed(w, u, 0, owners)
    if not runs:
        return text, []
    chars = np.concatenate([[0], np.cumsum((w.buffer & 0xC0) != 0x80)])
    spans, parts, at = [], [], 0
    for p, q, owner in runs:
        first, last = int(u.begin[p]), int(u.end[q - 1]) - 1
        start, end = int(w.starts[first]), int(w.ends[last])
        spans.append({"start": int(chars[start]), "end": int(chars[end]), "n_words": last - first + 1,
                      "first_doc": owner})
        following = int(w.starts[last + 1]) if last + 1 < len(w.starts) else len(text)
        opens_line = first == 0 or u.line[p] != u.line[p - 1]
        if opens_line or b"\n" not in text[end:following]:
            end = following  # the white space behind goes too
        elif first:
            start = int(w.ends[first - 1])  # the white space before goes; the line break stays
        parts.append(text[at:max(at, start)])
        at = max(at, end)
    return b"".join(parts) + text[at:], spans


SPAN = "struct<start:long,end:long,n_words:long,first_doc:long>"


def _cut_all(text: pd.Series, digests: pd.Series, owners: pd.Series, others: pd.Series) -> pd.DataFrame:
    done = []
    for t, d, o, x in zip(text, digests, owners, others):
        found = None if d is None else {a: b if c else None for a, b, c in zip(d.tolist(), o.tolist(), x.tolist())}
        done.append((None, None) if t is None or d is None else _cut(t, found))
    return pd.DataFrame({"text": [x[0] for x in done], "spans": [x[1] for x in done]})


def with_cuts(docs: DataFrame, name: str = "cuts") -> DataFrame:
    """``docs`` and a column ``struct<text, spans>``: the text without what occurs earlier, and the
    removed ``spans``, ``array<struct<start, end, n_words, first_doc>>`` with offsets in code
    points of the original text (``first_doc`` null: the earlier occurrence is in the document
    itself). Null where nothing is removed, as for null and empty texts. An empty table gives no rows."""
    marks = marked_units(docs)
    key = {c: free_name(docs, f"cut_{c}") for c in marks.columns}
    marks = marks.select(*[F.col(c).alias(n) for c, n in key.items()])
    found = docs.join(marks, F.col("doc_id").eqNullSafe(F.col(key["doc_id"])) & (F.xxhash64("text") == F.col(key["text_key"])), "left")
    units = F.col(key["units"])
    parts = [units["digest"], F.transform(units, lambda u: F.coalesce(u["owner"], F.lit(0))), F.transform(units, lambda u: u["owner"].isNotNull())]
    # texts without marks need not reach Python
    text = F.when(F.col(key["units"]).isNotNull(), F.col("text").cast("binary"))
    found = found.withColumn(name, F.pandas_udf(_cut_all, f"struct<text:binary,spans:array<{SPAN}>>")(text, *parts))
    spans = F.col(f"{name}.spans")
    return (found.withColumn(name, F.when(F.size(spans) > 0, F.struct(F.col(f"{name}.text").cast("string").alias("text"), spans.alias("spans"))))
            .drop(*key.values()))


def removed_spans(docs: DataFrame) -> DataFrame:
    """One row per removed span: ``doc_id, start, end, n_words, first_doc``."""
    return (with_cuts(docs.select("doc_id", "text")).where("cuts is not null")
            .select("doc_id", F.explode("cuts.spans").alias("s")).select("doc_id", "s.*"))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns, each text without what occurs earlier; ``n_chars``, where the
    table has it, is the new text's. Every row stays, if need be with an empty text."""
    name = free_name(docs, "cuts")
    cut = with_cuts(docs, name)
    text = F.coalesce(F.col(f"{name}.text"), F.col("text"))
    size = F.when(F.col(name).isNotNull(), F.char_length(F.col(f"{name}.text")).cast("long"))
    new = {"text": text} | ({"n_chars": F.coalesce(size, F.col("n_chars"))} if "n_chars" in docs.columns else {})
    return cut.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])
