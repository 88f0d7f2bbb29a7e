"""Stored index: ids, positions, search that reads the wanted folders alone, ranking without rounding."""

import random
import uuid
from collections import Counter, defaultdict

import pytest

from webloom.operators import graph, index, search
from webloom.session import ensure_checkpoint_dir
from webloom.sources import index_store


@pytest.fixture
def root(spark):
    return f"{ensure_checkpoint_dir(spark)}/test-index/{uuid.uuid4().hex}"


def lexicon(spark, rows):
    return spark.createDataFrame(rows, "word_id long, word string")


def stored(spark, root):
    return sorted(map(tuple, index_store.read_index_table(spark, root, "lexicon").collect()))


def test_rows_with_ids_go_in_like_one_after_the_other(spark, root):
    r = random.Random(1)
    tables = [[(r.randint(1, 30), r.choice("abcdefghijklmnopqrst")) for _ in range(40)] for _ in range(3)]
    ids, words, want = set(), set(), []
    for rows in tables:
        kept = []
        for i, w in sorted(rows):
            if i not in ids and w not in words:
                kept.append((i, w))
                ids.add(i)
                words.add(w)
        want += kept
        skipped = index_store.append_if_absent(spark, root, "lexicon", lexicon(spark, rows), "word_id", "word")
        # Every row that is not stored is reported, repeated ones as well.
        assert Counter(map(tuple, skipped.collect())) == Counter(rows) - Counter(kept)
    assert stored(spark, root) == sorted(want)


def test_words_without_ids_are_all_numbered(spark, root):
    words = lambda ws: spark.createDataFrame([(w,) for w in ws], "word string")
    index_store.allocate_absent(spark, root, "lexicon", words(["b", "d", "b"]), "word_id", "word")
    index_store.allocate_absent(spark, root, "lexicon", words(["a", "b", "c", None, "e"]), "word_id", "word")
    index_store.allocate_absent(spark, root, "lexicon", words(["a"]), "word_id", "word")
    assert stored(spark, root) == [(1, "b"), (2, "d"), (3, "a"), (4, "c"), (5, "e")]


@pytest.mark.parametrize("block", [3, 1024])
def test_positions_come_back_from_the_store(spark, root, block):
    texts = [(1, "red blue red the red"), (2, "blue " * 50), (3, ""), (4, None), (5, "only the of")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    toks = index.tokens(docs)
    blocks, lex = index.position_blocks(toks, block)
    index_store.write_positions(blocks, root, buckets=4)
    held = index_store.read_positions(spark, root)
    assert max(len(r.gaps) for r in held.collect()) <= block
    ids = {r.word: r.word_id for r in lex.collect()}
    got = Counter(map(tuple, index.raw_postings(held, block).collect()))
    assert got == Counter((ids[r.word], r.doc_id, r.pos) for r in toks.collect())
    tf = {(r.word_id, r.doc_id): r.tf for r in index.term_frequency(held).collect()}
    assert tf[ids["red"], 1] == 3 and tf[ids["blue"], 2] == 50


def test_search_reads_the_folders_of_its_words_alone(spark, root, capsys):
    words = [(k, f"w{k}") for k in range(1, 65)]
    inv = spark.createDataFrame([(k, d) for k in range(1, 65) for d in range(1, 8) if (k + d) % 3], "word_id long, doc_id long")
    index_store.append_if_absent(spark, root, "lexicon", lexicon(spark, words), "word_id", "word")
    index_store.append_if_absent(spark, root, "doc_index", spark.createDataFrame(
        [(d, f"http://h/{9 - d}") for d in range(1, 8)], "doc_id long, url string"), "doc_id", "url")
    index_store.write_postings(inv, root)
    # Scores apart by less than 1e-9 still decide the order.
    scores = {d: 0.25 + d * 1e-12 for d in range(1, 7)}  # 7 has no rank
    index_store.write_page_rank(spark.createDataFrame(list(scores.items()), "doc_id long, score double"), root)
    queries = spark.createDataFrame([(1, "W3  w5 w3"), (2, "none"), (3, "w7")], "query_id long, keywords string")
    got = search.stored_search(spark, root, queries)
    pairs = {(r.word_id, r.doc_id) for r in inv.collect()}
    want = []
    for q, asked in ((1, [3, 5, 3]), (3, [7])):
        sums = {d: sum((w, d) in pairs for w in asked) * s for d, s in scores.items()}
        best = sorted((d for d in sums if sums[d]), key=lambda d: (-sums[d], d))
        want += [(q, k + 1, f"http://h/{9 - d}", sums[d]) for k, d in enumerate(best)]
    assert sorted(map(tuple, got.collect())) == want
    hits = index_store.read_postings(spark, root, lexicon(spark, [(3, "w3"), (7, "w7")]).select("word_id"))
    hits.explain("formatted")
    plan = capsys.readouterr().out
    assert "PartitionFilters: [bucket" in plan
    assert len(pairs) > hits.count() > 0


def test_pages_of_results_beyond_the_group_limit(spark):
    r = random.Random(3)
    rows = [(q, d, r.choice([0.5, 0.25, 0.25 + 1e-13])) for q in (1, 2) for d in range(1, 1040 if q == 1 else 4)]
    scored = spark.createDataFrame(rows, "query_id long, doc_id long, score double").repartition(5)
    by_query = defaultdict(list)
    for q, d, s in sorted(rows, key=lambda x: (x[0], -x[2], x[1])):
        by_query[q].append((d, s))
    for page in (1, 2, 207, 208, 300):
        got = sorted(map(tuple, search.search_page(scored, page).collect()))
        want = [(q, page, -(-len(v) // 5), k + 1, *v[k]) for q, v in by_query.items() for k in range(5 * page - 5, min(5 * page, len(v)))]
        assert got == want


def test_report_ranks_before_rounding(spark):
    ranks = spark.createDataFrame([(1, 1e-10), (2, 3e-10), (3, 2e-10)], "doc_id long, score double")
    urls = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "doc_id long, url string")
    assert [r.url for r in graph.rank_report(ranks, urls).orderBy("rank").collect()] == ["b", "c", "a"]


def test_page_rank_leaves_the_session_as_it_was(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.range(1).write.mode("overwrite").saveAsTable("webloom_kept")
    try:
        graph.page_rank(spark.createDataFrame([(1, 2), (2, 1)], "from_id long, to_id long"), num_iterations=2)
        assert {k: spark.conf.get(k) for k in before} == before
        assert [t.name for t in spark.catalog.listTables() if t.name.startswith("webloom_")] == ["webloom_kept"]
    finally:
        spark.sql("DROP TABLE webloom_kept")
