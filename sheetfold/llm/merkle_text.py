"""Document fingerprints: a Merkle tree over sections and paragraphs, DataFrame functions only.

A text splits at blank lines into sections, a section at line breaks into paragraphs and a paragraph
into leaves of ``LEAF`` code points. A leaf's node is the SHA-256 of its text, and every other
node that of its children's nodes in order; so two roots are equal exactly when the texts are
equal, and unequal trees are descended along their unequal branches only. The fingerprint
writes the tree out, leaves included, with shortened nodes; how much of two texts is alike is
read from the leaves that two fingerprints hold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheetfold.llm.common import let
from sheetfold.operators.joins import sized_side

#: Code points of a leaf.
LEAF = 16
#: Hex digits of a node in a fingerprint.
DIGITS = 8


def tree(text: Column) -> Column:
    """The Merkle tree of a text (null counts as empty): ``struct<root, sections array<struct<node,
    paragraphs array<string>, leaves array<array<string>>>>>``. Nodes are lower-case hex; ``leaves``
    are each paragraph's, shortened to ``DIGITS``."""
    def node(nodes):
        return F.sha2(F.array_join(nodes, ""), 256)

    def paragraph(p):
        leaves = F.transform(F.regexp_extract_all(p, F.lit(r"[^\n]{1,%d}" % LEAF), F.lit(0)), lambda x: F.sha2(x, 256))
        return let(leaves, lambda x: F.struct(node(x).alias("node"), F.transform(x, lambda d: F.substring(d, 1, DIGITS)).alias("leaves")))

    def section(s):
        return let(F.transform(F.split(s, "\n", -1), paragraph), lambda ps: F.struct(
            node(F.transform(ps, lambda p: p["node"])).alias("node"), F.transform(ps, lambda p: p["node"]).alias("paragraphs"),
            F.transform(ps, lambda p: p["leaves"]).alias("leaves")))

    sections = F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n", -1), section)
    return let(sections, lambda s: F.struct(node(F.transform(s, lambda x: x["node"])).alias("root"), s.alias("sections")))


def serialised(t: Column) -> Column:
    """A tree as one string: the root, then by section (``/``) each paragraph's (``;``) node and leaves (``.``),
    shortened to ``DIGITS``."""
    def paragraph(node, leaves):
        return F.array_join(F.concat(F.array(F.substring(node, 1, DIGITS)), leaves), ".")
    return F.concat_ws(":", t["root"], F.array_join(F.transform(t["sections"], lambda s: F.array_join(
        F.zip_with(s["paragraphs"], s["leaves"], paragraph), ";")), "/"))


def leaves(t: Column) -> Column:
    """The distinct leaves of a tree, as its fingerprint holds them."""
    return F.array_distinct(F.flatten(F.transform(t["sections"], lambda s: F.flatten(s["leaves"]))))


def likeness(a: Column, b: Column) -> Column:
    """1 for equal roots, else twice the leaves in common over the leaves of both (Dice), below 1."""
    def dice(x, y):
        both = F.size(x) + F.size(y)
        return F.when(both > 0, 2.0 * F.size(F.array_intersect(x, y)) / both).otherwise(F.lit(0.0))
    near = let(leaves(a), lambda x: let(leaves(b), lambda y: dice(x, y)))
    return F.when(a["root"] == b["root"], F.lit(1.0)).otherwise(F.least(near, F.lit(0.999999)))


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Where ``b`` was edited: ``array<struct<section, paragraph>>`` (from 0) of paragraphs whose
    nodes differ or that only one tree has. Equal roots, and equal sections, are not descended."""
    def positions(x, y):
        return F.transform(F.filter(F.transform(F.arrays_zip(x.alias("l"), y.alias("r")),
                                                lambda p, i: F.struct(i.alias("i"), p.alias("p"))),
                                    lambda e: ~e["p"]["l"].eqNullSafe(e["p"]["r"])), lambda e: e["i"])

    pairs = F.transform(F.arrays_zip(a["sections"].alias("l"), b["sections"].alias("r")),
                        lambda p, i: F.struct(i.alias("i"), p["l"].alias("l"), p["r"].alias("r")))
    unequal = F.filter(pairs, lambda e: ~e["l"]["node"].eqNullSafe(e["r"]["node"]))
    none = F.array().cast("array<string>")
    found = F.flatten(F.transform(unequal, lambda e: F.transform(
        positions(F.coalesce(e["l"]["paragraphs"], none), F.coalesce(e["r"]["paragraphs"], none)),
        lambda j: F.struct(e["i"].alias("section"), j.alias("paragraph")))))
    return F.when(a["root"] == b["root"], F.array().cast("array<struct<section:int,paragraph:int>>")).otherwise(found)


def _cuts_below(cuts: list[float], number: Column) -> Column:
    """How many of the sorted cuts lie below a number: among every ``step``-th one, then in one run of them."""
    step = max(1, math.isqrt(len(cuts)))

    def constant(values):
        return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>") if values else F.array().cast("array<double>")

    runs = F.size(F.filter(constant(cuts[step - 1::step]), lambda c: c < number))
    return runs * step + F.size(F.filter(F.slice(constant(cuts), runs * step + 1, F.lit(step)), lambda c: c < number))


def with_next_text(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """``doc_id, text, next_text``: the next document's text by descending id (the last one's next
    is the first's), every null text as empty, null ids last.

    The ids are cut into ``ranges`` ranges at approximate quantiles, so that no task needs the
    whole order: a window runs within a range, and the first rows of a range are also sent, as
    helpers that return no row, to the range above it. Texts are shuffled once. Rows with equal
    ids count as documents of their own, ordered by text.
    """
    spark = docs.sparkSession
    ranges = ranges or max(64, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shares = [k / ranges for k in range(1, ranges)]
    cuts = sorted(set(rows.approxQuantile("doc_id", shares, 1 / (4 * ranges)))) if shares else []
    number = F.col("doc_id").cast("double")
    rows = rows.withColumn("_range", F.when(number.isNull(), F.lit(-1)).otherwise(_cuts_below(cuts, number)))
    # per range: its highest id, and the range that comes before it in descending order
    tops = rows.groupBy("_range").agg(F.max("doc_id").alias("_top"))
    order = Window.orderBy(F.col("_range"))
    above = F.lead("_range").over(order)
    first = F.min("_range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tops = tops.select(F.col("_range").alias("_r"), "_top", F.coalesce(above, first).alias("_to"))
    tops = sized_side(tops, max_rows=ranges + 1, checkpoint=True)
    own = F.struct(F.col("_range").alias("at"), F.lit(False).alias("helper"))
    sent = F.struct(F.col("_to").alias("at"), F.lit(True).alias("helper"))
    both = (rows.join(tops, (F.col("_range") == F.col("_r")) & F.col("doc_id").eqNullSafe(F.col("_top")), "left")
            .select("doc_id", "text", F.explode(F.when(F.col("_r").isNotNull(), F.array(own, sent))
                                                .otherwise(F.array(own))).alias("_place"))
            .select("doc_id", "text", F.col("_place.at").alias("_range"), F.col("_place.helper").alias("_helper")))
    down = Window.partitionBy("_range").orderBy("_helper", F.desc_nulls_last("doc_id"), "text")
    return (both.withColumn("next_text", F.lead("text").over(down)).where(~F.col("_helper"))
            .select("doc_id", "text", "next_text"))


def edited_text(text: Column, other: Column) -> Column:
    """The last half (floor) of ``text``'s code points replaced by the first as many of ``other``, or all of it."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n - half).cast("int")), F.substring(other, F.lit(1), half))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Each document with its tree, its edited text, that text's tree and the next document's tree:
    ``doc_id, n_chars, edited_text, tree, edited_tree, next_tree``."""
    paired = with_next_text(docs)
    edited = paired.withColumn("edited_text", edited_text(F.col("text"), F.col("next_text")))
    trees = F.transform(F.array("text", "edited_text", "next_text"), tree)
    return (edited.withColumn("_trees", trees)
            .select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "edited_text",
                    F.col("_trees")[0].alias("tree"), F.col("_trees")[1].alias("edited_tree"),
                    F.col("_trees")[2].alias("next_tree")))
