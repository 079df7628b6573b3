"""Hierarchical packing of tokenised documents into sequences of several context sizes.

A document's ids, closed by an end id, are routed to the shortest tier (a context size, a power of
two) that holds them; longer ones give whole windows first, and their rest is routed. Each tier is
packed from the longest to the shortest: a window begins with one of the tier's documents and its
gap is filled with the largest whole documents of shorter tiers that fit, then by cutting one of
them. What no shorter document can fill is poured, cut at window ends, so that every sequence has
exactly the length of a tier and none is padded, but for the last ids of a task, which become sequences
of falling powers of two. Sequences are then dealt into step groups of about equal tokens and
equal attention cost.

A task packs its own documents, in runs of about ``RUN_TOKENS`` ids: nothing is shuffled, and a
run's ids are all that a task holds.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetfold.llm.tokens import encoder
from sheetfold.llm.words import slices

#: Context sizes, longest first.
TIERS = (2048, 1024, 512, 256)
END_ID = 1
#: Ids packed together.
RUN_TOKENS = 1 << 20
#: Ids of one step group, about.
STEP_TOKENS = 1 << 16


class Piece(NamedTuple):
    doc: int      # index of its document in the run
    start: int    # its document's ids before it
    length: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return Piece(self.doc, self.start, at), Piece(self.doc, self.start + at, self.length - at)


class Stock:
    """Pieces by length; the largest of at most some length is found in a bit mask."""

    def __init__(self, longest: int):
        self.by = [[] for _ in range(longest + 1)]
        self.there = 0

    def put(self, p: Piece) -> None:
        self.by[p.length].append(p)
        self.there |= 1 << p.length

    def largest(self, most: int) -> int:
        """The largest length of at most ``most`` in stock, 0 if there is none."""
        return (self.there & ((2 << most) - 1)).bit_length() - 1 if self.there & ((2 << most) - 1) else 0

    def take(self, length: int) -> Piece:
        p = self.by[length].pop()
        if not self.by[length]:
            self.there ^= 1 << length
        return p


def pour(pieces: Iterable[Piece], sizes: Iterator[int]) -> list[list[Piece]]:
    """``pieces`` one after the other into windows of the given sizes, cut at their ends."""
    windows: list[list[Piece]] = []
    gap = 0
    for p in pieces:
        while p.length:
            if not gap:
                gap = next(sizes)
                windows.append([])
            now, p = p.cut(min(gap, p.length))
            windows[-1].append(now)
            gap -= now.length
    return windows


def pack_run(lengths: list[int], left: list[Piece], tiers: tuple[int, ...], last: bool) -> tuple[list[list[Piece]], list[Piece]]:
    """Windows of the documents with these ``lengths`` and of pieces ``left`` over, and what is left
    over again: fewer ids than a longest window, none if this is the ``last`` run."""
    longest = tiers[0]
    windows, stock = [], Stock(longest)
    for p in left:
        stock.put(p)
    for doc, n in enumerate(lengths):
        whole = n // longest * longest
        windows += [[Piece(doc, a, longest)] for a in range(0, whole, longest)]
        if n > whole:
            stock.put(Piece(doc, whole, n - whole))
    rest: list[Piece] = []
    for tier, below in zip(tiers, [*tiers[1:], 0]):
        while (n := stock.largest(tier)) > below:
            window, gap = [stock.take(n)], tier - n
            shorter = below or tier             # the shortest tier fills up with its own documents
            while gap and (n := stock.largest(min(gap, shorter))):
                window.append(stock.take(n))
                gap -= n
            if gap and (n := stock.largest(shorter)):
                fits, over = stock.take(n).cut(gap)
                window.append(fits)
                stock.put(over)
                gap = 0
            if gap:
                rest += window
            else:
                windows.append(window)
    total = sum(p.length for p in rest)
    sizes = [longest] * (total // longest)
    if last:
        sizes += [1 << b for b in range(longest.bit_length() - 1, -1, -1) if total % longest >> b & 1]
        return windows + pour(rest, iter(sizes)), []
    poured = pour(rest, iter([*sizes, longest]))
    return windows + poured[:len(sizes)], [p for w in poured[len(sizes):] for p in w]


def step_groups(windows: list[list[Piece]], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A step group for every window: largest first, each to the group with fewest ids so far and,
    among those, the least attention cost (the sum of the squares of the pieces' lengths)."""
    size = [sum(p.length for p in w) for w in windows]
    cost = [sum(p.length ** 2 for p in w) for w in windows]
    groups = [(0, 0, g) for g in range(max(1, round(sum(size) / step_tokens)))]
    found = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: (-size[i], -cost[i], i)):
        ids, work, g = groups[0]
        heapq.heapreplace(groups, (ids + size[i], work + cost[i], g))
        found[i] = g
    return found


OUT = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_id long"


def _pack(path: str, tiers: tuple[int, ...], end_id: int, run_tokens: int, step_tokens: int):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                        ("tier", pa.int32()), ("step_id", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        enc = encoder(path, spaces=False)
        first = TaskContext.get().partitionId() << 32
        docs: list[tuple[int | None, bytes]] = []       # the documents of a run: those left over lead it
        left: list[Piece] = []
        sequences = steps = held = 0

        def packed(last: bool):
            nonlocal docs, left, sequences, steps, held
            old = 1 + max((p.doc for p in left), default=-1)
            windows, left = pack_run([0] * old + [len(ids) // 4 for _, ids in docs[old:]], left, tiers, last)
            groups = step_groups(windows, step_tokens)
            out: list[tuple] = []
            for s, (window, group) in enumerate(zip(windows, groups)):
                at, tier = 0, sum(p.length for p in window)
                for p in window:
                    doc_id, ids = docs[p.doc]
                    out.append((doc_id, p.start, p.length, ids[4 * p.start:4 * (p.start + p.length)], len(ids) // 4,
                                first + sequences + s, at, tier, first + steps + group))
                    at += p.length
            sequences, steps = sequences + len(windows), steps + max(groups, default=-1) + 1
            kept = sorted({p.doc for p in left})
            docs, left = [docs[d] for d in kept], [p._replace(doc=kept.index(p.doc)) for p in left]
            held = 0
            for i in range(0, len(out), 1024):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out[i:i + 1024]), schema)], schema=schema)

        for batch in slices(batches, 256):
            for doc_id, ids in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1).to_pylist())):
                docs.append((doc_id, ids.tobytes() + end))
                held += len(ids) + 1
                if held >= run_tokens:
                    yield from packed(False)
        if docs:
            yield from packed(True)
    return run


def tier_pack(docs: DataFrame, tokenizer: str, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID,
              run_tokens: int = RUN_TOKENS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """All ids of ``docs`` (``doc_id, text``; others are ignored) as packed pieces: ``doc_id, start,
    length, ids, doc_tokens, sequence_id, offset, tier, step_id``.

    A document's ids are those that the ``tokenizers`` file at ``tokenizer`` (one that drops white
    space; every executor can read it) gives its text, then ``end_id``; ``doc_tokens`` counts them.
    Each id lies in exactly one piece: ``start`` of its document's ids come before it, ``ids`` are
    little-endian unsigned 32-bit numbers. ``offset``: the piece's place in its sequence, gapless
    from 0. ``tier``: the sequence's length, one of ``tiers`` (powers of two, longest first) or, for
    the last ids of a task, a smaller power of two. ``step_id``: the sequence's step group, of
    ``step_tokens`` ids on average.

    Null and empty texts are the end id alone; a null id stays null; rows that share an id are documents
    of their own, told apart by nothing but their sequences; an empty table gives no rows.
    """
    if list(tiers) != sorted(set(tiers), reverse=True) or any(t & (t - 1) for t in tiers):
        raise ValueError("tiers are falling powers of two")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_pack(tokenizer, tuple(tiers), end_id, run_tokens, step_tokens), OUT)
