"""Surrogate keys (dictionary encoding): D1 lexicon ids, D2 document ids, D3 edge encoding.

Ids are dense (1..n) in value order, so they are deterministic and identical
on every run; the reference hands them out in first-seen order, which depends
on crawl order. Numbering uses ``row_numbers`` (range partitions plus
per-partition offsets), never a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.operators.distribute import row_numbers


def dense_ids(values: DataFrame, value_col: str, id_col: str) -> DataFrame:
    """``values`` holds one column of (possibly repeated) values; returns ``(id_col, value_col)``."""
    distinct = values.select(value_col).distinct()
    return row_numbers(distinct, order_by=[value_col], out=id_col).select(id_col, value_col)


def build_lexicon(tokens: DataFrame) -> DataFrame:
    """``lexicon(word_id, word)`` from a token table with a ``word`` column."""
    return dense_ids(tokens.select("word"), "word", "word_id")


def build_doc_index(urls: DataFrame) -> DataFrame:
    """``doc_index(doc_id, url)``; ``urls`` is the union of captured pages and link targets."""
    return dense_ids(urls.select("url"), "url", "doc_id")


def encode_edges(links: DataFrame, doc_index: DataFrame) -> DataFrame:
    """D3: ``(from_url, to_url)`` pairs → ``(from_id, to_id)`` through two equi-joins."""
    src = doc_index.select(F.col("url").alias("from_url"), F.col("doc_id").alias("from_id"))
    dst = doc_index.select(F.col("url").alias("to_url"), F.col("doc_id").alias("to_id"))
    return links.join(src, "from_url").join(dst, "to_url").select("from_id", "to_id")
