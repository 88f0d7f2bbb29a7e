"""Index tables on storage: sinks K1-K4 and scans S3-S6.

Layout under a root folder (any Hadoop-compatible path; on a cluster a
shared one):

    lexicon/         (word_id, word)              K1, S4
    doc_index/       (doc_id, url)                K2, S3
    inverted_index/  (word_id, doc_id) partitioned by word bucket   K3, S5
    page_rank/       (doc_id, score)              K4, S6

    positions/       (word_id, doc_id, block, gaps) partitioned by word bucket

``append_if_absent`` is the reference's insert rule for the lexicon and
the document index: a new row whose id *or* value already exists is
skipped; only the rest is appended. ``allocate_absent`` is for values without
ids: it numbers those that are not stored. Both append, so existing data is
never rewritten. ``page_rank`` is written with overwrite
(re-running the job replaces the ranks instead of failing).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from webloom import schemas
from webloom.operators.distribute import row_numbers
from webloom.session import materialize

POSTING_BUCKETS = 64

SCHEMAS = {
    "lexicon": schemas.LEXICON,
    "doc_index": schemas.DOC_INDEX,
    "inverted_index": schemas.INVERTED_INDEX,
    "page_rank": schemas.PAGE_RANK,
}


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def read_index_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan one index table with its schema; a missing table reads as empty."""
    try:
        return spark.read.schema(SCHEMAS[name]).parquet(table_path(root, name))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMAS[name])


def doc_index_both_ways(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """S3: url → id and id → url views of the document index (DataFrames, never collected)."""
    d = read_index_table(spark, root, "doc_index")
    return d.select("url", "doc_id"), d.select("doc_id", "url")


def append_if_absent(spark: SparkSession, root: str, name: str, rows: DataFrame,
                     id_col: str, value_col: str) -> DataFrame:
    """K1/K2 with given ids: append the rows whose id and value are both new; return every row not stored.

    Among the new rows the smallest (id, value) goes first, as if they were inserted in that order: a row is left
    out only for one that is stored. In each round the rows that are smallest both for their id and for their value
    are taken; most inputs need one round.
    """
    existing = read_index_table(spark, root, name)
    rows = materialize(rows.select(id_col, value_col))
    left = materialize(
        rows.distinct().join(existing.select(id_col), id_col, "left_anti")
        .join(existing.select(value_col), value_col, "left_anti").select(id_col, value_col))
    taken = []
    while not left.isEmpty():
        first = left.groupBy(value_col).agg(F.min(id_col).alias(id_col)).join(
            left.groupBy(id_col).agg(F.min(value_col).alias(value_col)), [id_col, value_col])
        taken.append(materialize(first.select(id_col, value_col)))
        left = materialize(left.join(taken[-1].select(id_col), id_col, "left_anti")
                           .join(taken[-1].select(value_col), value_col, "left_anti").select(id_col, value_col))
    fresh = rows.limit(0)
    for part in taken:
        fresh = fresh.unionByName(part)
    # It depends on the table as it was before the append.
    skipped = materialize(rows.exceptAll(fresh))
    if taken:
        fresh.write.mode("append").parquet(table_path(root, name))
    return skipped


def allocate_absent(spark: SparkSession, root: str, name: str, values: DataFrame, id_col: str, value_col: str) -> DataFrame:
    """K1/K2 without ids: give every value that is not stored yet the next free id, in value order, and append it.

    Ids go on from the largest stored one, so no value is lost to an id that is taken. Returns the rows appended.
    """
    existing = read_index_table(spark, root, name)
    last = existing.agg(F.max(id_col)).first()[0] or 0
    absent = values.select(value_col).where(F.col(value_col).isNotNull()).distinct().join(
        existing.select(value_col), value_col, "left_anti")
    numbered = row_numbers(absent, order_by=[value_col], out=id_col)
    fresh = materialize(numbered.select((F.col(id_col) + F.lit(last)).alias(id_col), value_col))
    fresh.write.mode("append").parquet(table_path(root, name))
    return fresh


def _bucket(col: str, buckets: int):
    return F.pmod(F.xxhash64(col), F.lit(buckets)).cast("int")


def write_postings(inv: DataFrame, root: str, buckets: int = POSTING_BUCKETS) -> None:
    """K3: postings in folders by a hash bucket of ``word_id``, sorted by (word_id, doc_id).

    Writers are fed by range partitions of (bucket, word_id, doc_id), so a task
    writes a few buckets in order, and a word with postings in a third of all
    documents is written by many tasks (several files in its bucket folder).
    """
    (
        inv.select("word_id", "doc_id")
        .withColumn("bucket", _bucket("word_id", buckets))
        .repartitionByRange("bucket", "word_id", "doc_id")
        .sortWithinPartitions("bucket", "word_id", "doc_id")
        .write.mode("overwrite").partitionBy("bucket")
        .parquet(table_path(root, "inverted_index"))
    )


def read_postings(spark: SparkSession, root: str, wanted: DataFrame | None = None,
                  buckets: int = POSTING_BUCKETS) -> DataFrame:
    """Postings ``(word_id, doc_id)``; with ``wanted`` (rows with a ``word_id`` among others, bounded by the
    query side) those of its words, with its columns.

    Only the folders of the wanted words' buckets are read: their numbers (at most ``buckets`` of them) are collected
    and become a partition filter.
    """
    inv = spark.read.schema(f"{schemas.INVERTED_INDEX.toDDL()}, bucket int").parquet(table_path(root, "inverted_index"))
    if wanted is None:
        return inv.select("word_id", "doc_id")
    found = [r[0] for r in wanted.select(_bucket("word_id", buckets)).distinct().collect()]
    return inv.where(F.col("bucket").isin(found)).drop("bucket").join(wanted, "word_id")


def write_positions(blocks: DataFrame, root: str, buckets: int = POSTING_BUCKETS) -> None:
    """K3 with places: blocks ``(word_id, doc_id, block, gaps)`` in folders by a hash bucket of ``word_id``, written
    by ranges of (bucket, word_id, doc_id, block), so a frequent word is written by many tasks."""
    (
        blocks.select("word_id", "doc_id", "block", "gaps")
        .withColumn("bucket", _bucket("word_id", buckets))
        .repartitionByRange("bucket", "word_id", "doc_id", "block")
        .sortWithinPartitions("bucket", "word_id", "doc_id", "block")
        .write.mode("overwrite").partitionBy("bucket")
        .parquet(table_path(root, "positions"))
    )


def read_positions(spark: SparkSession, root: str) -> DataFrame:
    """S5 with places: the stored blocks ``(word_id, doc_id, block, gaps)``."""
    return spark.read.parquet(table_path(root, "positions")).select("word_id", "doc_id", "block", "gaps")


def write_page_rank(ranks: DataFrame, root: str) -> None:
    """K4: overwrite the ranks."""
    ranks.select("doc_id", "score").write.mode("overwrite").parquet(table_path(root, "page_rank"))
