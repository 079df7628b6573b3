"""Approximate nearest neighbours with a forest of hash prefixes.

Every tree gives a vector a long hash string, one bit per random hyperplane that halves a sample,
and keeps the strings sorted. A query finds in each tree the longest prefix that it shares with
stored strings, and all trees then ascend together, one bit at a time, until the prefixes hold
enough candidates. The candidates' distances are computed on the original vectors.

Rows with equal vectors form one class, and one entry in each tree; of a class only the members
with the smallest ids can be among a query's nearest, and these are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheetfold.llm.common import store
from sheetfold.operators.joins import sized_side

#: Trees, bits of a hash string, and candidates (counted in every tree) at which the ascent stops at the earliest.
TREES, BITS, CANDIDATES = 64, 32, 16_000
#: Candidates as a share of all classes that the ascent needs besides, so recall holds as the table grows.
SHARE = 0.4
#: Vectors that the halving thresholds are fitted to, at most.
SAMPLE = 4096
#: Vectors per sorted array and per block of vectors, about.
ARRAY, BLOCK = 1 << 15, 4096


class Forest:
    """Hyperplanes and thresholds of all trees, fitted to a sample of vectors."""

    def __init__(self, sample: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = 5):
        self.trees, self.bits = trees, bits
        self.planes = np.random.Generator(np.random.PCG64(seed)).normal(size=(sample.shape[1], trees * bits)).astype(np.float32)
        self.middle = np.median(self._project(sample), axis=0)

    def _project(self, vectors: np.ndarray) -> np.ndarray:
        size = np.maximum(np.abs(vectors).max(axis=1, keepdims=True), 1e-300)  # no overflow in single precision
        unit = vectors / size
        return (unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-300)).astype(np.float32) @ self.planes

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """Hash strings as numbers, the first bit the highest (vectors x trees)."""
        above = (self._project(vectors) > self.middle).reshape(len(vectors), self.trees, self.bits)
        return (above * (np.int64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.int64))).sum(axis=2)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, class, v`` (double) of the distinct rows that take part: those with an id and with
    a vector that is not null, not zero and holds finite components only. ``class`` is a digest of
    the vector. Where vectors differ in length, those of the most frequent length take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    good = (F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
            & F.exists("v", lambda x: x != 0))
    rows = rows.where("vec_id is not null and v is not null").where(good)
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.size("v") == (length["n"] if length else 0))
    plain = F.transform("v", lambda x: x + F.lit(0.0))  # -0.0 equals 0.0
    return rows.select("vec_id", F.xxhash64(plain).alias("class"), "v")


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().reshape(rows, -1)


def _string_rows(forest):
    def run(batches):
        trees = forest.value.trees
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                found = forest.value.strings(_matrix(part.column("v"), part.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(part.column("class").to_numpy(), trees)), pa.array(np.tile(np.arange(trees, dtype=np.int32), len(found))),
                     pa.array(found.ravel())], names=["class", "tree", "string"])
    return run


def _answered(batches) -> Iterator[tuple[pa.Table, pa.Table]]:
    """From rows sorted by ``part, kind``: each part's stored rows (kind 0, held) with each run of
    rows that ask it (kind 1, passing through)."""
    held, part = [], None
    for batch in batches:
        parts, kinds = batch.column("part").to_numpy(), batch.column("kind").to_numpy()
        cuts = np.flatnonzero((np.diff(parts) != 0) | (np.diff(kinds) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(parts)]):
            if a == b:
                continue
            if parts[a] != part:
                held, part = [], parts[a]
            rows = batch.slice(a, b - a)
            if kinds[a] == 0:
                held.append(rows)
            elif held:
                held = [pa.Table.from_batches(held).combine_chunks()] if not isinstance(held[0], pa.Table) else held
                yield held[0], pa.Table.from_batches([rows])


def _level_counts(low: int, bits: int):
    """For every query and array the number of strings that share the query's first x bits, for x from ``low`` on."""
    def run(batches):
        for stored, asks in _answered(batches):
            strings, q = stored.column("string").to_numpy(), asks.column("string").to_numpy()
            counts = np.zeros((len(q), bits + 1), np.int64)
            for x in range(low, bits + 1):
                begin = (q >> (bits - x)) << (bits - x)
                counts[:, x] = np.searchsorted(strings, begin + (1 << (bits - x))) - np.searchsorted(strings, begin)
            yield pa.RecordBatch.from_arrays([asks.column("class").combine_chunks(), pa.array(list(counts), pa.list_(pa.int64()))],
                                             names=["query", "counts"])
    return run


def _prefix_members(bits: int, blocks: int):
    """For every query and array the classes that share the query's first ``level`` bits, a row per block of vectors."""
    def run(batches):
        for stored, asks in _answered(batches):
            strings, classes = stored.column("string").to_numpy(), stored.column("class").to_numpy()
            query, block, found = [], [], []
            for c, q, level in zip(*(asks.column(x).to_pylist() for x in ("class", "string", "level"))):
                begin = (q >> (bits - level)) << (bits - level)
                a, b = np.searchsorted(strings, [begin, begin + (1 << (bits - level))])
                some = classes[a:b]
                of = some % blocks
                order = np.argsort(of, kind="stable")
                cuts = np.flatnonzero(np.diff(of[order])) + 1
                for p in np.split(order, cuts):
                    if len(p):
                        query.append(c), block.append(int(of[p[0]])), found.append(some[p])
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(block, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                                             names=["query", "part", "classes"])
    return run


def _nearest(keep: int):
    """For every query and block the ``keep`` nearest of its candidates there (null: of all), ties to the smaller id."""
    def run(batches):
        for stored, asks in _answered(batches):
            classes = stored.column("class").to_numpy()
            order = np.argsort(classes)
            components = _matrix(stored.column("v"), stored.num_rows).T.copy()
            least = stored.column("least_id").to_numpy()
            q = _matrix(asks.column("v"), asks.num_rows)
            out = []
            for i, (query, some) in enumerate(zip(asks.column("class").to_pylist(), asks.column("classes").to_pylist())):
                at = order if some is None else order[np.searchsorted(classes, some, sorter=order)]
                far = np.zeros(len(at))
                for part, own in zip(components, q[i]):  # component by component, so sums round alike everywhere
                    gap = part[at] - own
                    far += gap * gap
                far = np.sqrt(far)
                best = np.lexsort((least[at], far))[:keep]
                out.append((np.full(len(best), query), classes[at[best]], least[at[best]], far[best]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["query", "class", "least_id", "score"])
    return run


def _by_part(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("part").sortWithinPartitions("part", "kind", *order)


def nearest_neighbours(vectors: DataFrame, every: int = 100, k: int = 10, trees: int = TREES, bits: int = BITS,
                       candidates: int = CANDIDATES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` (``vec_id, embedding``) whose
    id is divisible by ``every`` its ``k`` nearest others found, by Euclidean distance in double
    precision, ties to the smaller id (all others, if there are fewer).

    What takes part says :func:`usable`; a row repeated with id and vector counts once, and rows
    with the query's own id are no candidates of it. The forest is fitted to at most about
    ``SAMPLE`` vectors and holds every one. The ascent stops at ``candidates``, or at ``SHARE`` of
    all distinct vectors if that is more. A query whose arrays hold fewer at their shortest prefix
    is compared with all vectors, in blocks.
    """
    spark = vectors.sparkSession
    rows = store(usable(vectors), "forest-rows")
    ids = rows.select("vec_id", "class").distinct()
    nth = F.row_number().over(Window.partitionBy("class").orderBy("vec_id"))
    members = store(ids.withColumn("nth", nth).where(F.col("nth") <= k + 1), "forest-members")
    classes = (rows.groupBy("class").agg(F.first("v").alias("v"))
               .join(members.where("nth = 1").select("class", F.col("vec_id").alias("least_id")), "class"))
    classes = store(classes, "forest-classes")
    count = classes.count()
    candidates = max(candidates, int(np.ceil(SHARE * count)))
    queries = ids.where(F.col("vec_id") % every == 0)
    asking = queries.select("class").distinct()
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks, low = -(-count // BLOCK), max(0, (-(-count // ARRAY) - 1).bit_length())
    sample = classes.where(F.pmod(F.xxhash64("class", F.lit(3)), F.lit(1 << 30)) <= int((1 << 30) * min(1.0, SAMPLE / count))).select("v")
    sample = np.array([r.v for r in sample.toLocalIterator()] or [classes.first().v])
    forest = spark.sparkContext.broadcast(Forest(sample, trees, bits))

    strings = store(classes.mapInArrow(_string_rows(forest), "class long, tree int, string long"), "forest-strings")
    # an array: the strings of one tree that begin with the same `low` bits
    array = (F.col("tree").cast("long") * (1 << low) + F.shiftright("string", bits - low)).alias("part")
    stored = strings.select(array, F.lit(0).alias("kind"), "class", "string", F.lit(0).alias("level"))
    asks = strings.join(sized_side(asking), "class").select(array, F.lit(1).alias("kind"), "class", "string")
    counted = _by_part(stored.unionByName(asks.withColumn("level", F.lit(0))), "string").mapInArrow(
        _level_counts(low, bits), "query long, counts array<long>")
    sums = counted.groupBy("query").agg(*[F.sum(F.col("counts")[x]).alias(f"n{x}") for x in range(low, bits + 1)])
    # the trees ascend together to the longest prefix with enough candidates
    level = F.coalesce(*[F.when(F.col(f"n{x}") >= candidates, F.lit(x)) for x in range(bits, low, -1)], F.lit(low))
    levels = store(sums.select(F.col("query").alias("class"), level.alias("level"), F.col(f"n{low}").alias("held")), "forest-levels")
    few = levels.where((F.col("held") < candidates) & F.lit(low > 0)).select("class")
    found = _by_part(stored.unionByName(asks.join(levels.select("class", "level"), "class")), "string").mapInArrow(
        _prefix_members(bits, blocks), "query long, part long, classes array<long>")
    found = found.groupBy("query", "part").agg(F.array_distinct(F.flatten(F.collect_list("classes"))).alias("classes"))
    found = found.join(few.select(F.col("class").alias("query")), "query", "left_anti")
    everywhere = few.select(F.col("class").alias("query"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("part"),
                            F.lit(None).cast("array<long>").alias("classes"))
    asked = found.unionByName(everywhere).join(classes.select(F.col("class").alias("query"), "v"), "query")
    kept = classes.select(F.pmod("class", F.lit(blocks)).cast("long").alias("part"), F.lit(0).alias("kind"), "class", "v", "least_id",
                          F.lit(None).cast("array<long>").alias("classes"))
    asked = asked.select("part", F.lit(1).alias("kind"), F.col("query").alias("class"), "v", F.lit(0).cast("long").alias("least_id"), "classes")
    near = _by_part(kept.unionByName(asked)).mapInArrow(_nearest(k + 1), "query long, class long, least_id long, score double")
    best = F.row_number().over(Window.partitionBy("query").orderBy("score", "least_id"))
    near = store(near.withColumn("_n", best).where(F.col("_n") <= k + 1).select("query", "class", "score"), "forest-near")

    pairs = (queries.select(F.col("vec_id").alias("query_id"), F.col("class").alias("query")).join(near, "query")
             .join(members.select("class", "vec_id"), "class").where("vec_id <> query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id", "query").orderBy("score", "vec_id"))
    return pairs.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
