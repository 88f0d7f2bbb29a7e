"""Readers for the captured tables and the inputs derived from them.

All readers use explicit schemas, so Parquet scans prune columns and push
filters; nothing is inferred at read time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from webloom import schemas


# Unique key of each table: used to spread a scan that arrives in too few splits.
TABLE_KEYS = {
    "pages": ["page_id"],
    "documents": ["doc_id"],
    "benchmark": ["item_id"],
    "conversations": ["conv_id", "turn"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "part": ["p_partkey"],
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """S2 (and the other driver tables): one Parquet table with its schema."""
    df = spark.read.schema(schemas.TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")
    return spread(df, TABLE_KEYS.get(name, []))


def spread(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Give a scan at least one partition per core.

    A large input arrives in many file splits and is returned unchanged. A
    scan of fewer splits than the default parallelism (one file of one row
    group) would run every row-level step (tokenising, HTML parsing) in a
    single task; it is hash-partitioned on its unique key instead (no sort,
    unlike a round-robin repartition, and deterministic on retry).
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys) if keys else df.repartition(cores)


def part_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link graph among parts: within an order, each line's part links to the next line's part.

    Order inside an order: l_linenumber, l_partkey, l_suppkey, l_quantity,
    l_extendedprice. One exchange by order; an order is a handful of lines.
    Result: ``(from_id, to_id)``, duplicates kept.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    lines = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    chain = li.select(F.col("l_partkey").alias("from_id"), F.lead("l_partkey").over(lines).alias("to_id"))
    return chain.where(F.col("from_id").isNotNull() & F.col("to_id").isNotNull())


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query table: each benchmark text, whole, is one query."""
    b = read_table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.col("text").alias("keywords"))


def misspelt_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same queries with the second character removed from words longer than 4 characters."""
    q = benchmark_queries(spark, sf_dir)
    words = F.split(F.col("keywords"), " ", -1)
    fixed = F.transform(
        words,
        lambda w: F.when(F.length(w) > 4, F.concat(F.substring(w, 1, 1), F.substring(w, 3, 2147483647)))
        .otherwise(w),
    )
    return q.select("query_id", F.array_join(fixed, " ").alias("keywords"))


def search_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of searches, four per benchmark text: the text, its misspelt form, one of its words with two letters too
    many, and one that no correction finds.

    ``query_id`` orders the stream (4 * item_id, ...), which is what "earlier successful searches" refers to for
    suggestions. The third and fourth take the text's first word of more than four letters; texts without one ask
    for nothing there.
    """
    orig = benchmark_queries(spark, sf_dir)
    typo = misspelt_queries(spark, sf_dir)
    long = F.try_element_at(F.filter(F.split("keywords", " ", -1), lambda w: F.length(w) > 4), F.lit(1))
    word = orig.select("query_id", F.coalesce(long, F.lit("")).alias("word"))
    rest = F.substring("word", 4, 2147483647)
    near = F.when(F.col("word") != "", F.concat(F.substring("word", 1, 3), F.lit("qz"), rest)).otherwise("")
    lost = F.when(F.col("word") != "", F.concat(F.substring("word", 1, 1), F.lit("qzqzqzq"), F.right("word", F.lit(1)))).otherwise("")
    out = None
    for k, part in enumerate([orig, typo, word.select("query_id", near.alias("keywords")), word.select("query_id", lost.alias("keywords"))]):
        part = part.select((F.col("query_id") * 4 + k).alias("query_id"), "keywords")
        out = part if out is None else out.unionByName(part)
    return out


def search_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search log ``(user_id, seq, text)``: user turns of the conversations."""
    c = read_table(spark, sf_dir, "conversations")
    return c.where(F.col("role") == "user").select(
        F.col("conv_id").alias("user_id"), F.col("turn").alias("seq"), "text"
    )


def sign_outs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-outs ``(user_id, seq)``: each user's first and last assistant turn."""
    turns = read_table(spark, sf_dir, "conversations").where(F.col("role") == "assistant").groupBy(
        F.col("conv_id").alias("user_id")).agg(F.min("turn").alias("first"), F.max("turn").alias("last"))
    return turns.select("user_id", F.explode(F.array_distinct(F.array("first", "last"))).alias("seq"))


__all__ = [
    "read_table",
    "spread",
    "part_chain",
    "benchmark_queries",
    "misspelt_queries",
    "search_log",
    "search_session",
    "sign_outs",
]
