"""Spark results equal the DuckDB oracle statements (sf0.001, a representative subset)."""

import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from webloom.plans.catalog import QUERIES
from webloom.plans.oracle import ORACLE_SQL

from sf_paths import SF_SMALL

TABLES = ["part", "lineitem", "documents", "pages", "benchmark", "conversations"]
NAMES = [
    "tokens", "lexicon", "inverted_index", "inverted_index_sets", "page_rank", "search", "search_page",
    "page_meta", "page_links", "font_weights", "resolved_index", "spell_correct", "history_top20",
    "recent_words", "crawl_frontier", "insert_if_absent", "suggestion_list",
    "page_events", "resolve_url", "seeds", "text_runs", "normalize_query", "query_word_counts",
    "history_counts", "doc_word_count", "stopword_filter", "link_counts", "out_degree", "in_links",
    "encode_edges", "hits", "term_lookup", "history_snapshot", "raw_postings", "term_frequency", "page_search",
    "page_crawl", "rank_report", "suggestions", "search_with_fallback",
]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_listed():
    assert set(QUERIES) == set(ORACLE_SQL)


def test_entry_runs(spark):
    df = entry(spark)
    assert df.columns == ["query_id", "rank", "doc_id", "score"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted((tuple(_norm(x) for x in r) for r in df.collect()), key=repr)
    rel = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want
