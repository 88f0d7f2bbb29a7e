"""Mixing sources to target weights by capped water-filling, JVM-side throughout.

Sources are clamped at ``max_epochs`` times their size and the excess is dealt again by weight until no
source is above its cap. Within a source every document is taken a whole number of times, and a seeded share
of the documents once more: the documents whose hash lies up to the source's cutoff. The cutoff is found by
radix descent over the hash (per level one map-side combined aggregation of words by source and digit; each
level keeps one digit in 2^DIGIT_BITS), so the words taken come within one document of the target, and no
source, however large, is sorted or gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import count_words, materialize
from webloom.operators.distribute import row_numbers

WEIGHTS = (5.0, 2.0, 1.0)
MAX_EPOCHS = 3.0
SEED = 42
HASH_BITS = 60
DIGIT_BITS = 10
LEVELS = 3
#: A source's rows meet its plan under this many salted keys, so a hot source is no single join key.
SALTS = 64


def doc_hash(id_col: str, seed: int) -> Column:
    """Seeded 60-bit hash of a document id; equal ids hash alike, so repeated rows are taken alike."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col).cast("long")), 64 - HASH_BITS)


def weigh(sources: DataFrame, weights: Sequence[float] = WEIGHTS) -> DataFrame:
    """Add ``weight``: the weights in turn over the sources by code point, null last."""
    ranked = row_numbers(sources, [F.col("source").asc_nulls_last()], out="_rank")
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("_rank") - 1) % len(weights) + 1).cast("int"))
    return ranked.withColumn("weight", turn).drop("_rank")


def water_fill(sources: DataFrame, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """Add ``target`` to ``(source, source_size, weight)``: shares of the total size by weight, none above
    ``max_epochs * source_size``.

    Each pass clamps the sources that the common level lifts to their cap; three sums per pass reach the
    driver. The level only rises, so it ends after at most one pass per clamped source.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0)
    level, clamped = 0.0, -1
    while True:
        over = cap <= F.col("weight") * F.lit(level)
        r = sources.agg(
            F.count(F.when(over, F.lit(1))).alias("n"),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("free"),
        ).first()
        if r["n"] == clamped or not r["free"]:
            return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)) if r["free"] else cap)
        clamped, level = r["n"], (total - r["fixed"]) / r["free"]


def _cutoffs(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``cut`` to ``plan`` (``source, need, ...``): of ``sized`` (``source, size, h``), the documents with
    ``h <= cut`` hold about ``need`` words."""
    digit = lambda level: F.shiftright("h", HASH_BITS - DIGIT_BITS * (level + 1)).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
    state = plan.select(F.col("source").alias("_s"), F.col("need").alias("_need"), F.lit(0).cast("long").alias("_start"))
    left = sized
    for level in range(LEVELS):
        # At most 2^DIGIT_BITS rows per source.
        sums = left.groupBy("source", digit(level).alias("digit")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("digit"))
        passed = (
            sums.select("source", "digit", "words", upto.alias("upto"))
            .join(state, F.col("source").eqNullSafe(F.col("_s")))
            .where(F.col("upto") > F.col("_need"))
            .groupBy("source").agg(F.min(F.struct("digit", "words", "upto", "_need", "_start")).alias("x"))
        )
        state = materialize(passed.select(
            F.col("source").alias("_s"), F.col("x.digit").alias("_d"),
            (F.col("x._need") - (F.col("x.upto") - F.col("x.words"))).alias("_need"),
            (F.col("x._start") + F.shiftleft("x.digit", HASH_BITS - DIGIT_BITS * (level + 1))).alias("_start"),
        ))
        left = materialize(
            left.join(state, F.col("source").eqNullSafe(F.col("_s")) & (digit(level) == F.col("_d")))
            .select(*sized.columns)
        )
    # What is left of a source shares all its hash digits: a document or a few.
    run = left.groupBy("source", "h").agg(F.sum("size").alias("words")).withColumn(
        "upto", F.sum("words").over(Window.partitionBy("source").orderBy("h")))
    last = (
        run.join(state, F.col("source").eqNullSafe(F.col("_s")))
        .groupBy("source", "_start")
        .agg(F.max(F.when(F.col("upto") - F.col("words") / 2 <= F.col("_need"), F.col("h"))).alias("_h"))
        .select(F.col("source").alias("_s"), F.coalesce("_h", F.col("_start") - 1).alias("_cut"))
    )
    # A source without a digit that passes the need is taken whole (its need is all it has, or nothing).
    every = F.when(F.col("need") > 0, F.lit((1 << HASH_BITS) - 1)).otherwise(F.lit(-1))
    return plan.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").select(
        *plan.columns, F.when(F.col("need") <= 0, F.lit(-1)).otherwise(F.coalesce("_cut", every)).cast("long").alias("cut"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """Per source: ``source, source_size, target, whole`` (times every document is taken) and ``cut`` (documents
    whose hash is at most this are taken once more)."""
    sized = materialize(docs.select(F.col(source_col).alias("source"), count_words(F.col(text_col)).alias("size"),
                                    doc_hash(id_col, seed).alias("h")))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = water_fill(materialize(weigh(sources, weights)), max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = materialize(plan.withColumn("whole", whole).withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")))
    return materialize(_cutoffs(sized, plan).drop("need"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, max_epochs: float = MAX_EPOCHS, seed: int = SEED,
        out: str = "repeats") -> DataFrame:
    """``docs`` with three columns more: ``<out>`` (times to take the row), ``<out>_target`` and
    ``<out>_source_size`` of its source.

    Size is the number of words, null text has none; a source without words has target 0 and its documents
    are taken 0 times. Null is a source of its own, ranked last. Rows that repeat an id are taken alike. An
    empty table stays empty. Reruns with one seed agree.
    """
    plan = mix_plan(docs, id_col, text_col, source_col, weights, max_epochs, seed).select(
        F.col("source").alias("_mix_source"), F.col("whole").alias("_mix_whole"), F.col("cut").alias("_mix_cut"),
        F.col("target").alias("_mix_target"), F.col("source_size").alias("_mix_size"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_mix_salt"))
    mark = docs.withColumn("_mix_h", doc_hash(id_col, seed))
    joined = mark.join(plan, F.col(source_col).eqNullSafe(F.col("_mix_source"))
                       & ((F.col("_mix_h") % SALTS).cast("int") == F.col("_mix_salt")))
    new = {
        out: F.col("_mix_whole") + (F.col("_mix_h") <= F.col("_mix_cut")).cast("long"),
        f"{out}_target": F.col("_mix_target"), f"{out}_source_size": F.col("_mix_size"),
    }
    return joined.select(*[f"`{c}`" for c in docs.columns if c not in new], *[v.alias(k) for k, v in new.items()])
