"""Explicit schemas: the driver tables read here and the index tables written."""

from pyspark.sql import types as T

PAGES = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("html", T.StringType()),
])

DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

BENCHMARK = T.StructType([
    T.StructField("item_id", T.LongType()),
    T.StructField("text", T.StringType()),
])

CONVERSATIONS = T.StructType([
    T.StructField("conv_id", T.LongType()),
    T.StructField("turn", T.LongType()),
    T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()),
])

LINEITEM = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()),
    T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampType()),
])

PART = T.StructType([
    T.StructField("p_partkey", T.LongType()),
    T.StructField("p_name", T.StringType()),
    T.StructField("p_brand", T.StringType()),
    T.StructField("p_type", T.StringType()),
    T.StructField("p_size", T.IntegerType()),
    T.StructField("p_retailprice", T.DoubleType()),
])

TABLES = {
    "pages": PAGES,
    "documents": DOCUMENTS,
    "benchmark": BENCHMARK,
    "conversations": CONVERSATIONS,
    "lineitem": LINEITEM,
    "part": PART,
}

# Index tables (the reference's four SQLite tables, plus page metadata).
LEXICON = T.StructType([
    T.StructField("word_id", T.LongType(), False),
    T.StructField("word", T.StringType(), False),
])
DOC_INDEX = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("url", T.StringType(), False),
])
INVERTED_INDEX = T.StructType([
    T.StructField("word_id", T.LongType(), False),
    T.StructField("doc_id", T.LongType(), False),
])
PAGE_RANK = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("score", T.DoubleType(), False),
])
DOC_META = T.StructType([
    T.StructField("doc_id", T.LongType(), False),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
])
