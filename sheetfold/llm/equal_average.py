"""Vector codes by product quantisation on integers, with equal-average nearest entry search.

A vector's components become integers and are cut into equal parts; each part position has a
codebook, refined by rounds of assignment and integer means. The nearest entry is found among the
entries sorted by the sum of their components: by Cauchy-Schwarz an entry whose sum differs from
the part's by ``g`` is at a squared distance of at least ``g * g / width``, so the search goes outward
from the part's own sum and ends where that bound strictly exceeds the best distance so far.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetfold.llm.common import store
from sheetfold.operators.joins import sized_side

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: A component x becomes floor(SCALE * x).
SCALE = 256
#: Integers times a part's width are below this in size, so that squared distances and gaps fit a long.
LIMIT = 1 << 28
#: Vectors handled at once by a task.
SLICE = 4096


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of ``PARTS * width`` integers; shorter vectors are filled up with zeros."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    sizes = np.diff(vectors.offsets.to_numpy())
    flat = np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(flat) and np.abs(flat).max() * width >= LIMIT:
        raise ValueError(f"a component of {LIMIT // SCALE // width} or more in size: its squared distances would not fit a long")
    out = np.zeros((len(sizes), PARTS * width), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat.astype(np.int64)
    return out


class Codebook:
    """One part position's entries, sorted by the sums of their components."""

    def __init__(self, entries: np.ndarray):
        sums = entries.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.sums, self.entries = sums[self.order], entries[self.order]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the nearest entry of each part (ties: the lowest) and its squared distance."""
        n, width = parts.shape
        far = np.iinfo(np.int64).max
        best, index = np.full(n, far), np.zeros(n, np.int64)
        sums = parts.sum(axis=1)
        up = np.searchsorted(self.sums, sums)
        down = up - 1
        open_ = np.arange(n)
        last = len(self.sums) - 1
        while len(open_):
            s, u, d = sums[open_], up[open_], down[open_]
            # the nearer of the two next entries; a side that has ended is farther than all
            above = np.where(u <= last, self.sums[np.minimum(u, last)] - s, far)
            below = np.where(d >= 0, s - self.sums[np.maximum(d, 0)], far)
            rise = above <= below
            gap = np.minimum(above, below)
            # ends where gap * gap / width > best (whole numbers: a fraction above the best costs one more look)
            on = (gap < far) & (gap * np.where(gap < far, gap, 0) // width <= best[open_])
            open_, rise, u, d = open_[on], rise[on], u[on], d[on]
            at = np.where(rise, u, d)
            distance = ((parts[open_] - self.entries[at]) ** 2).sum(axis=1)
            entry = self.order[at]
            better = (distance < best[open_]) | ((distance == best[open_]) & (entry < index[open_]))
            best[open_[better]], index[open_[better]] = distance[better], entry[better]
            up[open_] += rise
            down[open_] -= ~rise
        return index, best


def assign(vectors: np.ndarray, codebooks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(codes, errors)`` of integer vectors, one column per part; ``codebooks``: parts x entries x width."""
    width = codebooks.shape[2]
    codes = np.zeros((len(vectors), len(codebooks)), np.int64)
    errors = np.zeros_like(codes)
    for p, entries in enumerate(codebooks):
        codes[:, p], errors[:, p] = Codebook(entries).nearest(vectors[:, p * width:(p + 1) * width])
    return codes, errors


def _sums(codebooks: np.ndarray):
    """Record batches of vectors → per task one row ``slot, n, total`` for each component of an entry in use."""
    parts, entries, width = codebooks.shape

    def run(batches):
        count = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                vectors = integers(batch.column(0).slice(i, SLICE), width)
                codes, _ = assign(vectors, codebooks)
                for p in range(parts):
                    count[p] += np.bincount(codes[:, p], minlength=entries)
                    for c in range(width):      # sums of a slice are whole numbers below 2^53
                        total[p, :, c] += np.bincount(codes[:, p], vectors[:, p * width + c], entries).astype(np.int64)
        used = np.flatnonzero(np.repeat(count.ravel() > 0, width))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.repeat(count.ravel(), width)[used]),
                                          pa.array(total.ravel()[used])], names=["slot", "n", "total"])
    return run


def train(vectors: DataFrame, first: list[list[float]], rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x width, integers) from the entries of the ``first`` vectors after
    ``rounds`` rounds over all ``vectors`` (one column, ``vector``): every entry becomes the floored
    mean of the parts nearest to it; one that is nearest to none stays. Sums are added per task
    first; the driver gets one row for each component of an entry."""
    longest = vectors.agg(F.max(F.size("vector"))).first()[0]
    width = -(-longest // PARTS)
    rows = integers(pa.array(first, pa.list_(pa.float64())), width)
    books = rows.reshape(len(rows), PARTS, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = vectors.mapInArrow(_sums(books), "slot long, n long, total long")
        flat = books.reshape(-1)
        for x in sums.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
            flat[x["slot"]] = x["total"] // x["n"]
    return books


def _encode(codebooks: np.ndarray):
    width = codebooks.shape[2]

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                part = batch.slice(i, SLICE)
                codes, errors = assign(integers(part.column("vector"), width), codebooks)
                hexes = codes.astype(np.uint8).tobytes().hex()
                k = 2 * len(codebooks)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), part.column("label"), pa.array([hexes[j:j + k] for j in range(0, len(hexes), k)], pa.string()),
                     pa.array(errors.sum(axis=1))], names=["vec_id", "label", "code", "error"])
    return run


def serialised(codebooks: np.ndarray) -> str:
    """All entries' components by part, entry and position, as decimal numbers joined by commas."""
    return ",".join(map(str, codebooks.ravel().tolist()))


RESULT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def vector_codes(table: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every usable row of ``table``
    (``vec_id, embedding, label``; others are ignored).

    Rows whose vector is null or holds a null or non-finite component are dropped. Components become
    ``floor(256 x)``; a codebook starts as the parts of the 64 smallest ids (a null id counts as the
    largest; rows that share an id are ordered by their components), or of all rows if there are
    fewer. ``code``: the nearest entry of each part, two hex digits each; ``error``: the squared
    distances to them, summed; ``label_error``: errors summed over the rows of equal label (nulls
    together). Vectors of unlike lengths, or of one that 16 does not divide, count as filled up with
    zeros to the longest, rounded up; an empty vector is all zeros. A component too large for squared
    distances in a long (2^20 over a part's width) raises an error. An empty table gives no rows.
    """
    spark = table.sparkSession
    rows = table.where(usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), "label")
    first = [x["vector"] for x in rows.orderBy(F.asc_nulls_last("vec_id"), "vector").select("vec_id", "vector").limit(ENTRIES).collect()]
    if not first or not any(first) and rows.where(F.size("vector") > 0).isEmpty():
        none = rows.select("vec_id", F.lit("00" * PARTS).alias("code"), F.lit(0).cast("long").alias("error"),
                           F.lit(0).cast("long").alias("label_error"))
        return none.withColumn("codebooks_sha256", F.lit(hashlib.sha256(b"").hexdigest()))
    books = train(rows.select("vector"), first, rounds)
    kind = rows.schema["label"].dataType.simpleString()
    coded = store(rows.mapInArrow(_encode(books), f"vec_id long, label {kind}, code string, error long"), "vector-codes")
    sums = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    digest = hashlib.sha256(serialised(books).encode()).hexdigest()
    return (coded.join(sized_side(sums, checkpoint=True), F.col("label").eqNullSafe(F.col("_label")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))
