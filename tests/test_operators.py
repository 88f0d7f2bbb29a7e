"""Operator behaviours: ignored elements, page edge cases, fonts, paging, snapshots, blocks, numbering."""

from pyspark.sql import functions as F

from webloom.operators import graph, history, index, pages as P, search
from webloom.operators.distribute import row_numbers


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_ignored_elements_and_missing_html(spark):
    html = ('<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script><style>p{x:1}</style>'
            '<meta charset="x"></head><body><p>keep</p><iframe src="a">drop me</iframe>'
            '<textarea>no</textarea><!-- note --></body></html>')
    pg = _pages(spark, [(1, "http://h.example/", html), (2, "http://h.example/x", "<p>no html tag</p>")])
    texts = [r.text for r in P.text_runs(pg).where("page_id = 1").orderBy("pos").collect()]
    assert texts == ["T", "keep", " note "]
    assert P.page_events(pg).where("page_id = 2").count() == 0
    meta = {r.page_id: (r.title, r.description) for r in P.page_meta(pg).collect()}
    assert meta == {1: ("T", "tkeep note "), 2: ("", "")}


def test_font_weights_clamp_and_inline_reset(spark):
    html = "<html><body></b></h1><p>a<b>b<i>c</p>d</i></b><h2>e<em>f</em></h2>g</body></html>"
    pg = _pages(spark, [(1, "http://h.example/", html)])
    runs = {r.pos: r.text for r in P.text_runs(pg).collect()}
    fonts = {runs[r.pos]: r.font for r in P.font_weights(pg).collect()}
    # stray closings never go below zero; inline weights restart at </p> (a block boundary)
    assert fonts == {"a": 0, "b": 2, "c": 3, "d": 0, "e": 6, "f": 7, "g": 0}


def test_search_page_slices_and_counts(spark):
    res = spark.createDataFrame([(0, r, 100 + r, 1.0 / r) for r in range(1, 13)],
                                "query_id long, rank long, doc_id long, score double")
    p2 = search.search_page(res, page_no=2).orderBy("rank").collect()
    assert [r.rank for r in p2] == [6, 7, 8, 9, 10] and {r.total_pages for r in p2} == {3}
    assert search.search_page(res, page_no=4).count() == 0


def test_history_snapshot_cut(spark):
    log = spark.createDataFrame([(1, 0, "a b"), (1, 1, "b c"), (1, 5, "z")], "user_id long, seq long, text string")
    outs = spark.createDataFrame([(1, 1), (1, 6)], "user_id long, seq long")
    snap = {(r.signout_seq, r.word, r.n, r.recent_rank) for r in history.history_snapshot(log, outs).collect()}
    # The second session starts anew; users without a sign-out would be in none.
    assert snap == {(1, "a", 1, 3), (1, "b", 2, 2), (1, "c", 1, 1), (6, "z", 1, 1)}


def test_posting_blocks_are_bounded(spark):
    inv = spark.range(0, 10000).select(F.lit(7).cast("long").alias("word_id"), F.col("id").alias("doc_id"))
    blocks = index.posting_blocks(inv, block=4096).orderBy("block_no").collect()
    assert [r.n_docs for r in blocks] == [4096, 4096, 1808]
    assert sum(len(r.doc_ids.split()) for r in blocks) == 10000


def test_row_numbers_hot_group_spans_partitions(spark):
    df = spark.range(0, 5000).select(
        F.when(F.col("id") < 4000, F.lit(1)).otherwise(F.col("id") % 7).alias("g"), (F.col("id") * 37 % 5000).alias("v")
    )
    ranked = row_numbers(df, order_by=["v"], partition_by=["g"], max_group_rows=0)  # force range partitions
    got = {(r.g, r.v): r.rn for r in ranked.collect()}
    windowed = {(r.g, r.v): r.rn for r in row_numbers(df, order_by=["v"], partition_by=["g"]).collect()}
    assert windowed == got
    rows = sorted((r.g, r.v) for r in df.collect())
    want, last, k = {}, None, 0
    for g, v in rows:
        k = k + 1 if g == last else 1
        last = g
        want[(g, v)] = k
    assert got == want


def test_crawl_frontier_minimum_depth(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (1, 3), (3, 4), (4, 5)], "from_id long, to_id long")
    seeds = spark.createDataFrame([(1,)], "id long")
    got = {r.id: r.depth for r in graph.crawl_frontier(seeds, edges, depth=2).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 2}
