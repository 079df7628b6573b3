"""Mixing sources to target weights.

Words are summed per source, targets follow by water-filling, a source's repetition rate is
``target / words``, and a document is emitted ``floor(rate)`` times plus one hash-seeded
Bernoulli copy with probability equal to the fraction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetfold.llm.common import free_name, store, word_count
from sheetfold.operators.joins import sized_side
from sheetfold.operators.rowid import dense_index

#: Weights by rank of the source name, repeating.
WEIGHTS = (3, 1, 2)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``(source, size)`` rows → ``source, source_size, weight, target``, one row per source.

    Sources rank by code point, null last, and take ``weights`` in turn. ``share`` times all
    words is dealt by weight; a target stops at ``most`` times its source's words and the excess
    is dealt again among the others until none is above. The rounds run on the table of sources
    and bring one row of sums to the driver each.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = dense_index(totals.withColumn("_null", F.col("source").isNull()), ["_null", "source"], "_rank", 0)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_rank") % len(weights)).cast("int") + 1)
    ranked = store(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "mix-sources")
    cap = F.lit(most) * F.col("source_size")
    all_sums = ranked.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    total = share * (all_sums["s"] or 0)
    rest, left = total, all_sums["w"] or 0
    while left:
        above = F.col("weight") * F.lit(float(rest)) / F.lit(float(left)) > cap
        sums = ranked.where(~above).agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
        open_words, open_weight = sums["s"] or 0, sums["w"] or 0
        if open_weight == left:
            break
        rest, left = total - most * (all_sums["s"] - open_words), open_weight
    level = F.col("weight") * F.lit(float(rest)) / F.lit(float(max(left, 1)))
    return ranked.withColumn("target", F.least(cap, level) if left else cap)


def _rate():
    return F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))


def _copies(rate, seed: int):
    """``floor(rate)``, and one more with probability equal to the fraction: 13 hexadecimal
    digits of an MD5 digest of seed and id, as a fraction of 16^13, fall below it."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    uniform = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(16 ** 13))
    return (F.floor(rate) + (uniform < rate - F.floor(rate)).cast("long")).cast("long")


def mix_plan(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
             most: float = 2.0) -> DataFrame:
    """``doc_id, size, source_size, target, rate, copies`` and the row's ``source``, one row per
    document (rows with the same id each count; a null text has size 0; an empty table gives no
    rows). ``copies`` depends on ``doc_id``, ``seed`` and the source's rate alone, so reruns and
    other partitionings agree. A source without words has target 0, rate 0."""
    sizes = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    sizes = store(sizes, "mix-sizes")
    targets = source_targets(sizes.select("source", "size"), weights, share, most)
    side = sized_side(targets.withColumnRenamed("source", "_src"))
    return (sizes.join(side, F.col("source").eqNullSafe(F.col("_src")))
            .withColumn("rate", _rate()).withColumn("copies", _copies(F.col("rate"), seed))
            .select("doc_id", "source", "size", "source_size", "target", "rate", "copies"))


def mix(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5,
        most: float = 2.0) -> DataFrame:
    """The mixed documents: every row of ``docs`` as often as its plan says, with its columns.

    The rate is a property of the source, so the texts meet the (size-checked) table of sources
    and are not shuffled by document."""
    sizes = docs.select("source", word_count(F.col("text")).alias("size"))
    targets = source_targets(sizes, weights, share, most)
    src, rate = free_name(docs, "mix_src"), free_name(docs, "mix_rate")
    side = sized_side(targets.select(F.col("source").alias(src), _rate().alias(rate)))
    copies = _copies(F.col(rate), seed)
    copy = free_name(docs, "mix_copy")
    return (docs.join(side, F.col("source").eqNullSafe(F.col(src)))
            .withColumn(copy, F.explode(F.array_repeat(F.lit(1), copies.cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
