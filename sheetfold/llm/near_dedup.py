"""MinHash near-duplicate groups with sequential Bayesian verification.

Every text becomes its set of word shingles and a MinHash signature. Rows with equal sets form a
class, and one signature stands for the class. Bands of the signature propose candidate pairs;
a pair's signatures are compared batch by batch, and the pair is dropped as soon as the posterior
probability that its similarity reaches the threshold falls below its share of ``miss``; survivors are
confirmed on the full shingle sets. Groups are the connected components of the confirmed links.

Within a bucket not all pairs are formed. First every member meets the bucket's best connected
member, the one with most neighbours over all buckets. Then only members still in different
components are compared, inside tasks over blocks of bounded size, with their shingle sets at
hand: a pair that passes the Bayesian comparison is verified there, and only links that join two
components of the task leave it, fewer than it has members. A bucket whose members turned out to be
one group costs nothing more, and no link that could join two components is left out.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetfold.llm.common import free_name, store
from sheetfold.llm.components import connected_components
from sheetfold.llm.words import chunks, mix64, shingle_sets, slices, words_of
from sheetfold.operators.joins import sized_side

#: 32 bands of 4 values: a pair at similarity 0.75 shares no band with probability 5e-6.
BANDS, ROWS = 32, 4
#: Values of a signature (the first BANDS * ROWS make the bands; all are compared) and their bytes:
#: the low 16 bits of a MinHash value, which differ for different values but once in 65536.
HASHES, WIDTH = 512, 2
#: Values compared at a time, and the probability of dropping a pair, spent evenly over all looks.
BATCH, MISS = 16, 1e-4
#: Members of a bucket, and shingles that they have together, compared with each other by one task.
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
_RNG = np.random.Generator(np.random.PCG64(20240229))
_A = _RNG.integers(1, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
_B = _RNG.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values (16 bits each) of a set of 64-bit shingle digests."""
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(x), 512):
        np.minimum(least, (x[i:i + 512, None] * _A + _B).min(axis=0), out=least)
    return least.astype(np.uint16)


@lru_cache(maxsize=None)
def fewest_matches(threshold: float, miss: float = MISS) -> tuple[int, ...]:
    """For each batch end ``n`` the fewest matches among ``n`` values with which a pair goes on:
    ``P(similarity >= threshold | m of n match) >= miss / looks`` under a uniform prior. The posterior
    is Beta(m + 1, n - m + 1), whose upper tail is a binomial sum."""
    out = []
    miss /= HASHES // BATCH
    for n in range(BATCH, HASHES + 1, BATCH):
        m = 0
        while sum(math.comb(n + 1, j) * threshold ** j * (1 - threshold) ** (n + 1 - j) for j in range(m + 1)) < miss:
            m += 1
        out.append(m)
    return tuple(out)


def _features(k: int):
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n_shingles", pa.int64()),
                        ("key_a", pa.int64()), ("key_b", pa.int64()), ("sig", pa.binary())])

    def run(batches):
        for batch in slices(batches):
            ids, keys, texts = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            n, keys_a, keys_b, sig = [], [], [], []
            for _, run_texts in chunks(texts):
                for s in shingle_sets(words_of(run_texts), k):
                    n.append(len(s))
                    if not len(s):
                        keys_a.append(None), keys_b.append(None), sig.append(None)
                        continue
                    # two sums over a set's digests, mixed in two ways: 128 bits, equal for equal sets
                    for out, salt in ((keys_a, 0x9E3779B97F4A7C15), (keys_b, 0xC2B2AE3D27D4EB4F)):
                        total = mix64(s ^ np.uint64(salt)).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(s))
                        out.append(int(total.view(np.int64)[0]))
                    sig.append(signature(s).tobytes())
            yield pa.RecordBatch.from_arrays([ids, keys, pa.array(n, pa.int64()), pa.array(keys_a, pa.int64()),
                                              pa.array(keys_b, pa.int64()), pa.array(sig, pa.binary())], schema=schema)
    return run


FEATURES = "doc_id long, text_key long, n_shingles long, key_a long, key_b long, sig binary"


def _text_rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                       F.col("text").cast("binary").alias("text"))


def _signatures(column: pa.Array, width: int = HASHES) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, width)


def passing(a: np.ndarray, b: np.ndarray, limits: tuple[int, ...]) -> np.ndarray:
    """Which of the paired rows of two signature tables outlast the comparison batch by batch."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for i, least in enumerate(limits):
        part = slice(i * BATCH, (i + 1) * BATCH)
        matches[alive] += (a[alive, part] == b[alive, part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive


def _bayes(threshold: float):
    limits = fewest_matches(threshold)

    def run(batches):
        for batch in slices(batches):
            alive = passing(_signatures(batch.column("sig_a")), _signatures(batch.column("sig_b")), limits)
            yield batch.select(["a", "b"]).take(pa.array(alive))
    return run


def alike(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sets of digests have ``100 * |intersection| >= percent * |union|``."""
    common = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * common >= percent * (len(p) + len(q) - common)


def _compare_blocks(percent: int):
    """Rows sorted by block pair (``part``) → links ``(a, b)`` of members of its two blocks (or of
    its one block) that join all that are connected there. Looked at are pairs in different
    components, whose sizes allow the similarity and whose first common band is this one; those
    that pass the Bayesian comparison are verified on their sets, unless links found before already
    connect them. So a block pair has fewer links than members."""
    limits = fewest_matches(percent / 100)[:BANDS * ROWS // BATCH]

    def compare(t: pa.Table):
        part, block, node, root, n, band = (t.column(c).to_numpy() for c in ("part", "block", "node", "root", "n_shingles", "band"))
        sig, single = _signatures(t.column("sig"), BANDS * ROWS), t.column("single").to_numpy()
        sets = t.column("shingles")
        bands = np.ascontiguousarray(sig).view(np.uint64)
        # what is known to be connected, within a block pair
        group = np.unique(np.stack([part, root]), axis=1, return_inverse=True)[1].ravel()
        digests: dict[int, np.ndarray] = {}

        def shingles(i: int) -> np.ndarray:
            if i not in digests:
                digests[i] = np.frombuffer(sets[i].as_py(), np.uint64)
            return digests[i]

        a, b = [], []
        for d in range(1, len(part)):
            i = np.flatnonzero(part[d:] == part[:-d])
            if not len(i):
                break
            j = i + d
            fit = ((group[i] != group[j]) & (single[i] | (block[i] != block[j]))
                   & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])))
            i, j = i[fit], j[fit]
            if len(i):
                kept = passing(sig[i], sig[j], limits)
                i, j = i[kept], j[kept]
                first = (bands[i] == bands[j]).argmax(axis=1) == band[i]
                for x, y in zip(i[first].tolist(), j[first].tolist()):
                    if group[x] != group[y] and alike(shingles(x), shingles(y), percent):
                        a.append(min(node[x], node[y])), b.append(max(node[x], node[y]))
                        group[group == group[y]] = group[x]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches):
        held, rows, size = [], 0, 0
        for batch in slices(batches, BLOCK):
            held.append(batch)
            rows, size = rows + batch.num_rows, size + batch.nbytes
            if rows >= 4 * BLOCK or size >= 32 * BLOCK_SHINGLES:
                t = pa.Table.from_batches(held)
                part = t.column("part").to_numpy()
                if part[0] != part[-1]:     # the last block pair may go on in the next batch
                    whole = int(np.flatnonzero(part != part[-1])[-1]) + 1
                    yield from compare(t.slice(0, whole))
                    held = t.slice(whole).to_batches()
                    rows, size = rows - whole, sum(x.nbytes for x in held)
        if rows:
            yield from compare(pa.Table.from_batches(held))
    return run


def _exact(k: int, percent: int):
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                texts = part.column("text_a").to_pylist() + part.column("text_b").to_pylist()
                distinct = list(dict.fromkeys(texts))
                sets = {}
                for begin, some in chunks(distinct):
                    sets.update(zip(some, shingle_sets(words_of(some), k)))
                keep = []
                for x, y in zip(texts[:part.num_rows], texts[part.num_rows:]):
                    keep.append(alike(sets[x], sets[y], percent))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The ``(a, b)`` pairs that pass the Bayesian comparison."""
    side = lambda c: classes.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sig_a", "sig_b")
    return both.mapInArrow(_bayes(percent / 100), "a long, b long")


def _sets(k: int):
    def run(batches):
        for batch in slices(batches, 256):
            texts = batch.column("text").to_pylist()
            sets = [x.tobytes() for _, some in chunks(texts) for x in shingle_sets(words_of(some), k)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])
    return run


def _texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``node, text``: a text of each of the classes."""
    rows = classes.join(nodes, "node", "left_semi").select("node", "rep_id", "rep_key")
    texts = _text_rows(docs)
    texts = texts.join(sized_side(rows), F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("text_key") == F.col("rep_key")))
    return texts.select("node", "text").dropDuplicates(["node"])


def _links_across(members: DataFrame, groups: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` that join a bucket's members in different components. A bucket is cut by a digest
    into blocks of about ``BLOCK`` members (fewer if they are long), and every two of its blocks meet
    in one task, with their shingle sets."""
    named = members.select("key", "band", "node", "n_shingles").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    needed = F.greatest(F.ceil(F.col("_n") / BLOCK), F.ceil(F.col("_size") / BLOCK_SHINGLES))
    mixed = (named.groupBy("key").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi"), F.count(F.lit(1)).alias("_n"),
                                      F.sum("n_shingles").alias("_size"))
             .where("_lo <> _hi").select("key", needed.cast("long").alias("_blocks")))
    rest = store(named.join(mixed, "key"), "near-rest")
    sets = _texts(rest.select("node").distinct(), classes, docs).mapInArrow(_sets(k), "node long, shingles binary")
    bands = classes.select("node", F.substring("sig", 1, BANDS * ROWS * WIDTH).alias("sig"))
    rest = rest.join(sets.join(bands, "node"), "node")
    rest = rest.withColumn("block", F.pmod(F.xxhash64("node"), F.col("_blocks")))
    rest = rest.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    rest = rest.select(F.xxhash64("key", F.least("block", "_other"), F.greatest("block", "_other")).alias("part"), "block",
                       (F.col("block") == F.col("_other")).alias("single"), "band", "node", "root", "n_shingles", "sig", "shingles")
    return rest.repartition("part").sortWithinPartitions("part").mapInArrow(_compare_blocks(percent), "a long, b long")


def _confirm(likely: DataFrame, classes: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The ``(a, b)`` pairs whose classes really are as similar as ``percent``, by their full sets."""
    likely = store(likely, "near-likely")
    needed = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    texts = store(_texts(needed, classes, docs), "near-texts")
    of = lambda c: texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}"))
    both = likely.join(of("a"), "a").join(of("b"), "b").select("a", "b", "text_a", "text_b")
    return store(both.mapInArrow(_exact(k, percent), "a long, b long"), "near-links")


def near_groups(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept``: one row per row of ``docs``.

    Two texts are linked if ``100 * |intersection| >= percent * |union|`` of their sets of
    ``k``-word shingles; ``component_id`` is the smallest ``doc_id`` reachable over links, itself
    included, and ``kept`` says that it is the row's own. Null texts and texts without words
    have no shingles and are linked with nothing. Rows with the same id are documents of their
    own; a null id is never the smallest while another id is in reach. ``text_key`` is the
    ``xxhash64`` of the text. An empty table gives no rows; other columns are ignored.
    """
    return _rooted_groups(docs, k, percent).drop("root")


def _rooted_groups(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The rows of :func:`near_groups` and ``root``, the component's own key (null without words):
    components of rows that share an id, or have none, differ in it only."""
    features = store(_text_rows(docs).mapInArrow(_features(k), FEATURES), "near-features")
    # a class is numbered as it is written, so unlike classes never share a node
    classes = store(features.where("n_shingles > 0").groupBy("key_a", "key_b").agg(
        F.min(F.struct("doc_id", "text_key")).alias("rep"), F.min("doc_id").alias("least_id"),
        F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
        .select(F.monotonically_increasing_id().alias("node"), "key_a", "key_b", "least_id", F.col("rep.doc_id").alias("rep_id"),
                F.col("rep.text_key").alias("rep_key"), "n_shingles", "sig"), "near-classes")
    size = ROWS * WIDTH
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.substring("sig", i * size + 1, F.lit(size))))
    bands = classes.select("node", "n_shingles", F.posexplode(keys).alias("band", "key"))
    shared = (bands.groupBy("key").agg(F.min("node").alias("_lo"), F.max("node").alias("_hi"), F.count(F.lit(1)).alias("in_bucket"))
              .where("_lo <> _hi").select("key", "in_bucket"))
    members = store(bands.join(shared, "key"), "near-members")

    # the best connected member of each bucket meets the others
    scores = members.groupBy("node").agg(F.sum("in_bucket").alias("score"))
    centres = (members.select("key", "node").join(scores, "node").groupBy("key")
               .agg(F.max(F.struct("score", "node")).alias("best")).select("key", F.col("best.node").alias("centre")))
    stars = (members.select("key", "node").join(centres, "key").where("node <> centre")
             .select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")).distinct())
    links = _confirm(_likely(stars, classes, percent), classes, docs, k, percent)
    groups = connected_components(links)
    # what is still in different components of a bucket is compared all over
    more = store(_links_across(members, groups, classes, docs, k, percent), "near-links")
    groups = connected_components(links.union(more))

    named = classes.select("node", "key_a", "key_b", "least_id").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    ids = named.join(ids, "root").select("key_a", "key_b", "root", "component_id")
    return (features.select("doc_id", "text_key", "n_shingles", "key_a", "key_b").join(ids, ["key_a", "key_b"], "left")
            .withColumn("component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
            .select("doc_id", "text_key", "n_shingles", "component_id",
                    F.col("component_id").eqNullSafe(F.col("doc_id")).alias("kept"), "root"))


def near_dedup(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id, and any one of a group's
    rows that share this id. Rows without words all stay, and so do rows of different groups that
    share an id or have none."""
    groups = store(_rooted_groups(docs, k, percent), "near-groups")
    key = {c: free_name(docs, f"near_{c}") for c in ("id", "text", "root")}
    own = [F.col("doc_id").alias(key["id"]), F.col("text_key").alias(key["text"])]
    same = F.col("doc_id").eqNullSafe(F.col(key["id"])) & (F.xxhash64("text") == F.col(key["text"]))
    kept = docs.join(sized_side(groups.where("not kept").select(*own).distinct()), same, "left_anti")
    kept_rows = groups.where("kept and n_shingles > 0")
    again = kept_rows.groupBy("root").count().where("count > 1").select("root")
    if again.limit(1).isEmpty():
        return kept
    again = kept_rows.join(again, "root", "left_semi").select(*own, F.col("root").alias(key["root"])).distinct()
    named = kept.join(sized_side(again), same, "left").drop(key["id"], key["text"])
    root = F.col(key["root"])
    return (named.where(root.isNull()).unionByName(named.where(root.isNotNull()).dropDuplicates([key["root"]]))
            .drop(key["root"]))
