"""Best-two-fit packing of tokenised documents into sequences.

A document's ids, closed by an end id, are cut into pieces only if they exceed a sequence. Pieces
are dealt by a digest into groups of bounded size, and each group is packed by itself: a bin is
filled greedily with the largest piece that fits, until none fits; then its smallest piece is
replaced by two unpacked ones, if two exist that fill the widened gap more tightly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetfold.llm.common import store
from sheetfold.llm.tokens import encoder

CAPACITY = 2048
END_ID = 0
#: Pieces packed together by one task; bins left open at a group's end are what grouping costs.
GROUP = 4_000
#: Words whose ids a Python worker keeps.
REMEMBER = 1 << 20


def _pieces(path: str, capacity: int, end_id: int, remember: int):
    def run(batches):
        enc = encoder(path, slots=remember)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                rows, piece, start, length, ids = [], [], [], [], []
                for r, found in enumerate(enc.encode(part.column("text").to_pylist())):
                    found = np.append(found, np.uint32(end_id))
                    first = len(found) % capacity or capacity
                    cuts = [0, *range(first, len(found) + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        rows.append(r), piece.append(k), start.append(a), length.append(b - a)
                        ids.append(found[a:b].astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])
    return run


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 remember: int = REMEMBER) -> DataFrame:
    """``doc_id, piece, start, length, ids``: each document's ids and ``end_id``, cut into pieces of
    ``capacity`` if there are more (the first piece is then the shorter one). ``ids`` are
    little-endian unsigned 32-bit numbers. Null and empty texts are the end id alone; rows that
    share an id are documents of their own. ``tokenizer``: the path of a ``tokenizers`` file that
    every executor can read; ``remember``: words whose ids a Python worker keeps, twice as many at most
    (about 150 bytes each)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(_pieces(tokenizer, capacity, end_id, remember), "doc_id long, piece int, start long, length long, ids binary")


def best_two_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of indexes into ``lengths`` (1 to ``capacity``), longest pieces first."""
    stock: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i in np.argsort(-np.arange(len(lengths))).tolist():
        stock[int(lengths[i])].append(i)
    there = sum(1 << n for n in range(1, capacity + 1) if stock[n])  # bit n: a piece of length n is left

    def take(n: int) -> int:
        nonlocal there
        i = stock[n].pop()
        if not stock[n]:
            there &= ~(1 << n)
        return i

    def put(n: int, i: int) -> None:
        nonlocal there
        stock[n].append(i)
        there |= 1 << n

    def largest(most: int) -> int:
        return (there & ((1 << (most + 1)) - 1)).bit_length() - 1

    bins = []
    while there:
        gap, own = capacity, []
        while gap and (n := largest(gap)) > 0:
            own.append((n, take(n)))
            gap -= n
        if gap and there:  # n falls from piece to piece: the last one is the smallest
            small, i = own.pop()
            room, best = gap + small, (small, 0)
            x = largest(room - 1)
            while x > 0 and 2 * x > best[0] and sum(best) < room:
                y = largest(min(room - x, x))
                if y == x and len(stock[x]) < 2:
                    y = largest(x - 1)
                if y > 0 and x + y > sum(best):
                    best = (x, y)
                x = largest(x - 1)
            if best[1]:
                put(small, i)
                own += [(n, take(n)) for n in best]
            else:
                own.append((small, i))
        bins.append([i for _, i in own])
    return bins


def _pack(capacity: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "number"], ignore_index=True)
        lengths = rows["length"].to_numpy()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for b, members in enumerate(best_two_fit(lengths, capacity)):
            sequence[members] = b
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
        return pd.DataFrame({"number": rows["number"], "sequence_id": (rows["group"].to_numpy() << 32) + sequence, "offset": offset})
    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity`` and any other columns) and ``sequence_id``,
    ``offset``: a piece's sequence and its place there; a sequence's pieces follow each other
    without a gap from 0. Only numbers and lengths meet by group, of ``group`` pieces on average;
    the pieces' other columns stay where they are written."""
    pieces = store(pieces.withColumn("_number", F.monotonically_increasing_id()), "pack-pieces")
    slim = pieces.select(F.col("_number").alias("number"), "length")
    groups = max(1, -(-slim.count() // group))
    slim = slim.withColumn("group", F.pmod(F.xxhash64("number"), F.lit(groups)))
    placed = slim.groupBy("group").applyInPandas(_pack(capacity), "number long, sequence_id long, offset long")
    return pieces.join(placed, pieces["_number"] == placed["number"]).drop("_number", "number")
