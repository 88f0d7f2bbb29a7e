"""Exact deduplication by distributed most-significant-digit radix partitioning.

Documents are split by successive runs of bytes ("digits") of their normalised text. Level k compares one
digit within the groups that level k-1 left; a group that holds one document, or whose texts have ended, is
finished. Equality is decided by the bytes alone, no digest takes part.

Each level is one aggregation (digit -> count, largest id; combined map-side, so a group of copies that holds
a third of all rows costs one row per task) and one join back, whose hot keys adaptive execution may split.
Digits grow by a fixed factor from level to level, so a text of n bytes takes about log(n) levels, and a level
reads only documents whose groups are still open. Levels are written to the checkpoint folder, which cuts the
lineage and survives lost executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import lower_ascii, materialize

FIRST_DIGIT = 64
DIGIT_GROWTH = 8


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                first_digit: int = FIRST_DIGIT, growth: int = DIGIT_GROWTH) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z; the row with the largest id stays. A null text
    counts as empty and equals an empty one. Rows that repeat an id with equal text belong to one group, and
    exactly those whose id is ``keep_id`` are marked kept; the same id with another text is another document.
    A null id ranks below every other (its group keeps null only if all its ids are null). Other columns are
    ignored; an empty table gives an empty result.
    """
    body = F.encode(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), "UTF-8")
    level = docs.select(F.col(id_col).cast("long").alias("doc_id"), body.alias("rest")).select(
        "doc_id", F.sha2("rest", 256).alias("text_sha256"), F.lit(0).cast("long").alias("grp"), "rest"
    )
    width, finished = first_digit, []
    while True:
        rows = level.withColumn("digit", F.substring("rest", 1, width))
        # Only digits that several documents share go on; the others end as singletons below.
        groups = materialize(
            rows.groupBy("grp", "digit")
            .agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"))
            .where("group_size > 1")
            .withColumn("next_grp", F.monotonically_increasing_id())
        )
        more = F.col("group_size").isNotNull() & (F.octet_length("digit") == width)
        split = materialize(
            # One plan at every size: a merge join, whose hot keys adaptive execution splits.
            rows.join(groups.hint("merge"), ["grp", "digit"], "left").select(
                "doc_id", "text_sha256",
                F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                F.coalesce("group_size", F.lit(1)).alias("group_size"),
                F.when(more, F.col("next_grp")).alias("grp"),
                F.when(more, F.expr(f"substring(rest, {width + 1})")).alias("rest"),
            )
        )
        finished.append(split.where("grp is null").select("doc_id", "keep_id", "group_size", "text_sha256"))
        level = split.where("grp is not null").select("doc_id", "text_sha256", "grp", "rest")
        if level.isEmpty():
            break
        width *= growth
    out = reduce(DataFrame.unionByName, finished)
    return out.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      "text_sha256")
