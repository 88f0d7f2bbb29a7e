"""How the index and search steps move their rows: what grows with hits or occurrences is not shuffled twice."""

import re
from collections import Counter

import pytest

from webloom.operators import index, pages, search
from webloom.plans import catalog
from webloom.session import materialize
from webloom.sources import index_store

DOCS = [(1, "red blue red"), (2, "blue green"), (2, "blue red"), (3, "the a"), (4, None), (5, "red " * 40 + "blue")]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_small_tables(spark):
    """Tables as the planner sees them at size: none broadcast by its own estimate."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


def occurrences():
    lex = {w: i for i, w in enumerate(sorted({w for _, t in DOCS for w in (t or "").split()} - {"the", "a"}), 1)}
    return Counter((lex[w], d, p) for d, t in DOCS for p, w in enumerate((t or "").split()) if w in lex)


def test_postings_keep_the_rows_of_a_frequent_word_where_they_are(no_small_tables):
    """a measured lexicon is broadcast instead of moving all rows by word."""
    inv, _ = index.inverted_index_from_pairs(index.all_word_doc_pairs(docs(no_small_tables)))
    blocks, _ = index.position_blocks(index.tokens(docs(no_small_tables)))
    for df in (inv, blocks):
        assert "BroadcastHashJoin [word" in plan(df) and "hashpartitioning(word" not in plan(df)
    assert Counter(map(tuple, inv.collect())) == Counter(
        {(w, d): 2 if (w, d) == (1, 2) else 1 for w, d, _ in occurrences()})


def test_a_large_lexicon_is_shuffled(no_small_tables, monkeypatch):
    small = index.inverted_index_from_pairs(index.all_word_doc_pairs(docs(no_small_tables)))[0].collect()
    monkeypatch.setattr(index, "LEXICON_BYTES", 0)
    inv, _ = index.inverted_index_from_pairs(index.all_word_doc_pairs(docs(no_small_tables)))
    assert "BroadcastHashJoin [word" not in plan(inv)
    assert Counter(inv.collect()) == Counter(small)


def test_positions_are_put_together_where_the_text_is(no_small_tables):
    """texts move once, by id; their occurrences do not."""
    toks = index.tokens(index.documents_apart(docs(no_small_tables)))
    by_place = plan(toks.groupBy("word", "doc_id", "pos").count())
    assert re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, ", by_place) == ["doc_id"]
    assert "hashpartitioning(word" not in by_place
    blocks, _ = index.position_blocks(toks, block=16)
    assert Counter(map(tuple, index.raw_postings(blocks, block=16).collect())) == occurrences()
    tf = Counter()
    for (w, d, _), n in occurrences().items():
        tf[w, d] += n
    assert {(r.word_id, r.doc_id): r.tf for r in index.term_frequency(blocks).collect()} == dict(tf)


def test_a_word_meets_its_documents_once_before_its_queries(no_small_tables):
    """Ranks are joined to words' documents, queries come last, from a broadcast."""
    spark = no_small_tables
    inv, lex = index.inverted_index_from_pairs(index.all_word_doc_pairs(docs(spark)))
    ranks = materialize(spark.createDataFrame([(1, 0.5), (2, 0.25), (5, 0.125)], "doc_id long, score double"))
    asked = [(1, "red red blue"), (2, "Blue"), (3, "nothing"), (4, ""), (5, None)]
    terms = search.query_terms(spark.createDataFrame(asked, "query_id long, keywords string"))
    got = search.term_lookup(terms, lex, inv, ranks)
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[(\w+)#", plan(got))
    assert joins[0] == ("BroadcastHashJoin", "word_id")  # the outermost one
    score, want = {1: 0.5, 2: 0.25, 5: 0.125}, Counter()
    for q, text in asked:
        for p, w in enumerate((text or "").lower().split()):
            for d, t in DOCS:
                if d in score and w in (t or "").split():
                    want[q, p, w, d, score[d]] += 1
    assert Counter(map(tuple, got.collect())) == want


def test_hits_of_a_stored_search_are_counted_by_document(no_small_tables, monkeypatch):
    """a task's groups are bounded; postings move by document before they meet the queries."""
    spark = no_small_tables
    root = catalog.index_root(spark)
    index_store.append_if_absent(spark, root, "lexicon", spark.createDataFrame([(1, "blue"), (2, "red")], "word_id long, word string"), "word_id", "word")
    index_store.append_if_absent(spark, root, "doc_index", spark.createDataFrame([(d, f"http://h/{d}") for d in range(1, 6)], "doc_id long, url string"), "doc_id", "url")
    index_store.write_postings(spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 3), (2, 5)], "word_id long, doc_id long"), root)
    index_store.write_page_rank(spark.createDataFrame([(1, 0.5), (2, 0.25), (3, 0.125), (4, 9.0)], "doc_id long, score double"), root)
    monkeypatch.setattr(search, "PAIRS_PER_TASK", 1)
    made, rank = [], search.rank_results
    monkeypatch.setattr(search, "rank_results", lambda scored: made.append(scored) or rank(scored))
    queries = spark.createDataFrame([(7, "red blue red"), (8, "RED"), (9, "none")], "query_id long, keywords string")
    got = {(r.query_id, r.url): r.score for r in search.stored_search(spark, root, queries).collect()}
    assert got == {(7, "http://h/1"): 0.5, (7, "http://h/2"): 0.75, (7, "http://h/3"): 0.25,
                   (8, "http://h/2"): 0.25, (8, "http://h/3"): 0.125}
    moved = plan(made[0])
    assert re.search(r"Exchange hashpartitioning\(doc_id#\d+L?, 8\), REPARTITION_BY_NUM", moved)
    assert "hashpartitioning(query_id" not in moved


def test_hits_keep_a_frequent_words_occurrences_where_they_are(no_small_tables):
    """the measured lexicon is broadcast, so occurrences do not move by word."""
    spark = no_small_tables
    rows = spark.createDataFrame([(1, "http://h/1", "<html><body><p>red blue red</p></body></html>"), (2, "http://h/2", "<html><body><b>red</b></body></html>")], "page_id long, url string, html string")
    lex = materialize(spark.createDataFrame([(1, "blue"), (2, "red")], "word_id long, word string"))
    hits = pages.hits(rows, lex)
    assert "hashpartitioning(word" not in plan(hits)
    assert Counter((r.page_id, r.word_id) for r in hits.collect()) == {(1, 2): 2, (1, 1): 1, (2, 2): 1}


def test_suggestions_keep_which_queries_found_something(spark, monkeypatch):
    """not all that they found."""
    session = spark.createDataFrame([(0, "red"), (1, "rd"), (2, "blue"), (3, "be")], "query_id long, keywords string")
    found = spark.createDataFrame([(q, None, k, k, 1.0) for q in (0, 2) for k in range(1, 30)],
                                  "query_id long, corrected string, rank long, doc_id long, score double")
    kept = []
    monkeypatch.setattr(catalog, "fallback_parts", lambda *_: (session, found))
    monkeypatch.setattr(catalog, "materialize", lambda df: kept.append(materialize(df)) or kept[-1])
    rows = catalog.q_suggestions(spark, "").collect()
    assert {(r.query_id, r.suggestion) for r in rows} == {(1, "red"), (3, "blue")}
    assert [(df.columns, df.count()) for df in kept] == [(["query_id", "corrected"], 2)]
