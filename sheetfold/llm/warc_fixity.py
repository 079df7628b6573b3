"""Merkle fixity audit of WARC replicas.

A replica is a table of records: ``archive`` (the WARC file), ``offset`` (of the record's first
byte in it) and ``record`` (its bytes). A record's digest covers offset, length and bytes. Leaves
of an archive's tree are the records of an offset range of ``LEAF`` bytes in order; above, a node
covers ``FANOUT`` ranges of the level below, up to one root per archive. The roots of two replicas
are compared first, and only branches that differ are descended, down to the damaged records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheetfold.llm.common import store

#: Bytes of a leaf's offset range, and nodes below a node.
LEAF, FANOUT = 1 << 16, 16
#: Levels above the leaves; the top level's one node covers LEAF * FANOUT ** LEVELS = 2^64 bytes.
LEVELS = 12


def record_digests(replica: DataFrame) -> DataFrame:
    """``archive, offset, length, digest``, one row per distinct record: a record stored twice at
    one place counts once. A null record counts as an empty one; rows without an archive or
    offset take no part."""
    body = F.coalesce(F.col("record").cast("binary"), F.lit(b""))
    rows = replica.where("archive is not null and offset is not null").select(
        "archive", F.col("offset").cast("long").alias("offset"), F.octet_length(body).cast("long").alias("length"),
        F.sha2(body, 256).alias("digest"))
    return rows.distinct()


def tree_level(below: DataFrame, span: int) -> DataFrame:
    """One level of the tree: nodes over ``span`` places of the level below, ``(archive, place,
    digest)``; a node's digest covers its children's places and digests in order. A node of the
    tree has at most ``FANOUT`` children, a leaf the distinct records of its range."""
    children = F.array_sort(F.collect_list(F.struct("place", "digest")))
    text = F.array_join(F.transform(children, lambda c: F.concat_ws(":", c["place"].cast("string"), c["digest"])), ",")
    return (below.withColumn("_node", F.floor(F.col("place") / span).cast("long")).groupBy("archive", "_node")
            .agg(F.sha2(text, 256).alias("digest")).select("archive", F.col("_node").alias("place"), "digest"))


def merkle_tree(records: DataFrame) -> list[DataFrame]:
    """The levels of a replica's trees over :func:`record_digests`, leaves first, roots last."""
    leaves = tree_level(records.select("archive", F.col("offset").alias("place"),
                                       F.concat_ws("-", F.col("length").cast("string"), F.col("digest")).alias("digest")), LEAF)
    levels = [store(leaves, "warc-leaves")]
    top = levels[0].agg(F.max("place").alias("m")).first()["m"] or 0
    while top and len(levels) <= LEVELS:
        levels.append(store(tree_level(levels[-1], FANOUT), "warc-level"))
        top //= FANOUT
    return levels


def _unequal(a: DataFrame, b: DataFrame, within: DataFrame | None) -> DataFrame:
    """The ``(archive, place)`` of nodes that differ or that one tree lacks, below ``within``'s nodes."""
    if within is not None:
        parent = F.floor(F.col("place") / FANOUT).cast("long")
        parents = within.withColumnRenamed("place", "_parent")
        a, b = (x.withColumn("_parent", parent).join(parents, ["archive", "_parent"], "left_semi").drop("_parent") for x in (a, b))
    b = b.withColumnRenamed("digest", "other")
    return a.join(b, ["archive", "place"], "full").where(~F.col("digest").eqNullSafe(F.col("other"))).select("archive", "place")


def fixity_audit(first: DataFrame, second: DataFrame) -> DataFrame:
    """The records in which two replicas differ: ``archive, offset, status, first_length,
    first_digest, second_length, second_digest``. ``status`` is ``altered``, ``missing`` (the
    second replica lacks it) or ``extra``. Equal replicas, and two empty ones, give no rows.
    Where one place holds several different records, those that only one replica has are listed."""
    digests = [store(record_digests(r), "warc-records") for r in (first, second)]
    trees = [merkle_tree(d) for d in digests]
    depth = max(len(t) for t in trees)
    for t in trees:  # the shorter tree grows to the height of the other
        while len(t) < depth:
            t.append(store(tree_level(t[-1], FANOUT), "warc-level"))
    found = None
    for a, b in zip(reversed(trees[0]), reversed(trees[1])):
        found = store(_unequal(a, b, found), "warc-unequal")
    leaf = F.floor(F.col("offset") / LEAF).cast("long")
    leaves = found.withColumnRenamed("place", "_leaf")
    a, b = (d.withColumn("_leaf", leaf).join(leaves, ["archive", "_leaf"], "left_semi").drop("_leaf") for d in digests)
    keys = ["archive", "offset", "length", "digest"]
    only_a, only_b = a.join(b, keys, "left_anti"), b.join(a, keys, "left_anti")
    named = lambda d, side: d.select("archive", "offset", F.col("length").alias(f"{side}_length"), F.col("digest").alias(f"{side}_digest"))
    status = (F.when(F.col("second_digest").isNull(), "missing").when(F.col("first_digest").isNull(), "extra").otherwise("altered"))
    return (named(only_a, "first").join(named(only_b, "second"), ["archive", "offset"], "full")
            .select("archive", "offset", status.alias("status"), "first_length", "first_digest", "second_length", "second_digest"))


def warc_record(uri: Column, body: Column) -> Column:
    """The bytes of a WARC/1.1 resource record of a page (null parts count as empty)."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(uri, F.lit("")),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.encode(F.concat(head, body, F.lit("\r\n\r\n")), "UTF-8")
