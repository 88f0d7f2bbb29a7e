"""Index build over captured pages: crawl selection, ids, postings and links.

``index_pages`` is the whole index job of the reference re-expressed on a
``pages`` table: the crawl (seeds, depth limit, visited filter) selects
which captured pages are read; all anchors of read pages become edges and
give ids to their targets (read or not); the read pages' words form the
lexicon and the inverted index.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.functions.urls import normalize_base
from webloom.operators import graph, index, keys, pages as P
from webloom.session import materialize


@dataclass
class PageIndex:
    doc_index: DataFrame      # (doc_id, url)
    links: DataFrame          # (from_url, to_url) one row per anchor of a read page
    edges: DataFrame          # (from_id, to_id)
    read_pages: DataFrame     # (page_id, doc_id) captured pages that were read
    pages: DataFrame          # the captured pages table

    # Word-side tables are built on first use: a link-only job (ranks, report)
    # never pays for tokenising or numbering the lexicon.
    @cached_property
    def _read(self) -> DataFrame:
        return self.pages.join(self.read_pages, "page_id")

    @cached_property
    def tokens(self) -> DataFrame:   # (doc_id, pos, tpos, word)
        return P.page_tokens(self._read.select("page_id", "url", "html")).join(self.read_pages, "page_id").select(
            "doc_id", "pos", "tpos", "word"
        )

    @cached_property
    def _inv_lex(self) -> tuple[DataFrame, DataFrame]:
        return index.inverted_index(self.tokens)

    @property
    def inverted_index(self) -> DataFrame:  # (word_id, doc_id)
        return self._inv_lex[0]

    @property
    def lexicon(self) -> DataFrame:  # (word_id, word)
        return self._inv_lex[1]

    @cached_property
    def meta(self) -> DataFrame:  # (doc_id, title, description)
        return P.page_meta(self._read.select("page_id", "url", "html")).join(self.read_pages, "page_id").select(
            "doc_id", "title", "description"
        )


def seeds_from_urls(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Seed list → ``(url, depth)`` with canonical URLs at depth 0; blank lines dropped."""
    u = F.regexp_replace(F.col(url_col), r"^[ \t\n\r\f\x0B]+|[ \t\n\r\f\x0B]+$", "")
    return urls.select(normalize_base(u).alias("url")).where(F.col("url") != "").distinct().withColumn(
        "depth", F.lit(0)
    )


def read_seed_file(spark, path: str) -> DataFrame:
    """S1 from a text file, one URL per line."""
    return seeds_from_urls(spark.read.text(path).withColumnRenamed("value", "url"))


def index_pages(pages: DataFrame, seeds: DataFrame | None = None, depth: int | None = None) -> PageIndex:
    """Build all index tables from captured pages.

    With ``seeds`` and ``depth`` the crawl decides which captured pages are read
    (breadth-first, minimum depth); otherwise every captured page is read.
    Captured rows sharing a canonical URL are one document (their words and
    links are merged).
    """
    canon = P.page_urls(pages)                                   # (page_id, url)
    # Anchors are read three times below (ids, crawl, edges): parse the HTML once
    # and keep the result as a table in the checkpoint folder. This also gives the
    # optimizer a leaf instead of the long URL-resolution expressions.
    all_links = materialize(P.page_links(pages).select("page_id", "from_url", "to_url"))
    urls = canon.select("url").unionByName(all_links.select(F.col("to_url").alias("url")))
    if seeds is not None:
        urls = urls.unionByName(seeds.select("url"))
    doc_index = keys.build_doc_index(urls)

    page_docs = canon.join(doc_index, "url").select("page_id", "doc_id")
    if seeds is not None and depth is not None:
        all_edges = keys.encode_edges(all_links.select("from_url", "to_url"), doc_index)
        seed_ids = seeds.join(doc_index, "url").select(F.col("doc_id").alias("id"))
        reach = graph.crawl_frontier(seed_ids, all_edges, depth=depth)
        # Pages at the depth limit are read, their targets only get ids.
        page_docs = page_docs.join(reach.select(F.col("id").alias("doc_id")), "doc_id", "left_semi")

    read_links = all_links.join(page_docs.select("page_id"), "page_id", "left_semi")
    edges = keys.encode_edges(read_links.select("from_url", "to_url"), doc_index)
    return PageIndex(doc_index, read_links.select("from_url", "to_url"), edges, page_docs, pages)
