"""Rule tests: stop words, tokens, query normalisation, spelling, history fold, PageRank, sinks."""

import random
import uuid

import duckdb
import pytest

from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from webloom.functions.text import STOP_WORDS, normalize_query
from webloom.operators import graph, history, index, search, spell
from webloom.session import ensure_checkpoint_dir
from webloom.sources import index_store


def test_stop_list_shape():
    assert len(STOP_WORDS) == 36 and len(set(STOP_WORDS)) == 36
    assert {chr(c) for c in range(ord("a"), ord("z") + 1)} <= set(STOP_WORDS)


def test_tokens_keep_dash_and_underscore(spark):
    df = spark.createDataFrame([(1, "Just testing :-*(@#*! word_four IS a Test &amp; 9")], "doc_id long, text string")
    got = [r.word for r in index.tokens(df).orderBy("pos").collect()]
    assert got == ["just", "testing", "-", "word_four", "test", "amp", "9"]


def test_normalize_query_collapses_runs_only(spark):
    df = spark.createDataFrame([("  Foo   BAR\tbaz  ",), ("a\t\tb",)], "t string")
    got = [r.n for r in df.select(normalize_query(F.col("t")).alias("n")).collect()]
    assert got == ["foo bar\tbaz", "a b"]


def _brute_correct(word, dictionary):
    def lev(a, b):
        prev = list(range(len(b) + 1))
        for i, ca in enumerate(a, 1):
            cur = [i]
            for j, cb in enumerate(b, 1):
                cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
            prev = cur
        return prev[-1]

    best = None
    for w, df in dictionary.items():
        d = lev(word, w)
        if d <= 2 and d < len(word):
            key = (d, -df, w)
            best = key if best is None or key < best else best
    return best[2] if best else word


def test_spelling_matches_brute_force(spark):
    dictionary = {"novel": 5, "mystery": 3, "never": 4, "finish": 2, "page": 9, "pages": 1,
                  "a" * 30: 1, "a" * 28 + "bb": 2, "the": 50, "word_four": 1}
    d = spark.createDataFrame(list(dictionary.items()), "word string, df long")
    words = ["nvel", "mystry", "nevr", "fnish", "pag", "the", "zzzzzz", "a" * 29, "a" * 31 + "b", "wordfour", "", "é"]
    q = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: r.correction for r in spell.correct_words(q, d).collect()}
    want = {w: _brute_correct(w, dictionary) for w in words}
    assert got == want


def test_spelling_of_random_words_of_every_length(spark):
    r = random.Random(7)
    word = lambda n: "".join(r.choice("abcd") for _ in range(n))
    dictionary = {word(n): r.randint(1, 4) for n in [1, 2, 2, 3, 3, 4, 4, 5, 5, 6, 6, 7, 8, 9, 12, 20, 33] for _ in range(6)}
    words = {word(r.randint(0, 9)) for _ in range(150)}
    for w in list(dictionary):
        for _ in range(2):
            cut = r.randint(0, len(w))
            words.add(w[:cut] + r.choice(["", "x", "xy", "é"]) + w[cut + r.randint(0, 2):])
    q = spark.createDataFrame([(w,) for w in words], "word string")
    d = spark.createDataFrame(list(dictionary.items()), "word string, df long")
    got = {x.word: x.correction for x in spell.correct_words(q, d).collect()}
    assert got == {w: _brute_correct(w, dictionary) for w in words}


def test_spelling_at_any_length_matches_brute_force(spark):
    r = random.Random(8)
    word = lambda n: "".join(r.choice("abcdef") for _ in range(n))
    words = ["", "z", "zy", "é", "éa", "zyx", "zyxw", "az", "zb", "q1"] + [word(n) for n in range(7) for _ in range(8)]
    q = spark.createDataFrame([(w,) for w in words], "word string")
    for lengths in ([1, 1, 2, 2, 2, 3, 4, 5], [2, 2, 3], [1, 4], [3, 3, 6]):
        dictionary = {word(n): r.randint(1, 4) for n in lengths for _ in range(4)}
        d = spark.createDataFrame(list(dictionary.items()), "word string, df long")
        got = {x.word: (x.correction, x.distance) for x in spell.correct_words(q, d, any_length=True).collect()}
        want = {}
        for w in words:
            near = sorted((duckdb_levenshtein(w, x), -df, x) for x, df in dictionary.items())
            want[w] = (near[0][2], near[0][0]) if near[0][0] <= 2 else (w, None)
        assert got == want


def duckdb_levenshtein(a, b):
    plain = "".join(c if c.isascii() else "~" for c in a)
    return duckdb.execute("SELECT levenshtein(?, ?)", [plain, b]).fetchone()[0]


def test_spell_correct_has_no_cut_by_length(spark, tmp_path):
    """A short unknown word and an empty one are corrected too, as the statement says."""
    spark.createDataFrame([(1, "at home to stay to"), (2, "to a be")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "zq home"), (2, ""), (3, "x")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = sorted(tuple(x) for x in queries()["spell_correct"](spark, str(tmp_path)).select("query_id", "pos", "word", "correction").collect())
    assert rows == [(1, 0, "zq", "to"), (1, 1, "home", "home"), (2, 0, "", "a"), (3, 0, "x", "a")]
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    assert sorted(con.execute(f"SELECT query_id, pos, word, correction FROM ({oracle_sql()['spell_correct']})").fetchall()) == rows


def test_recent_words_queue_rule(spark):
    log = spark.createDataFrame(
        [(1, 0, "a b c"), (1, 1, "a d e f g h i j k"), (1, 2, "l a"), (2, 0, "x x y")],
        "user_id long, seq long, text string",
    )
    got = {}
    for r in history.recent_words(log).collect():
        got.setdefault(r.user_id, []).append((r.rank, r.word))
    # Python deque(maxlen=10), append only if absent.
    # The final "a" was evicted by then, so it is queued again as the newest word.
    assert [w for _, w in sorted(got[1])] == ["a", "l", "k", "j", "i", "h", "g", "f", "e", "d"]
    assert [w for _, w in sorted(got[2])] == ["y", "x"]


def test_history_top_ties_follow_first_use(spark):
    log = spark.createDataFrame([(1, 0, "b a"), (1, 1, "a c b")], "user_id long, seq long, text string")
    got = [(r.rank, r.word, r.n) for r in history.history_top(log).orderBy("rank").collect()]
    assert got == [(1, "b", 2), (2, "a", 2), (3, "c", 1)]


def _py_pagerank(edges, sweeps=20, d=0.85):
    out = {}
    inn = {}
    for f, t in edges:
        out[f] = out.get(f, 0) + 1
        inn.setdefault(t, set()).add(f)
    n = len(out)
    pr = {k: 1.0 for k in out}
    for _ in range(sweeps):
        pr = {k: (1 - d) / n + d * sum(pr[s] / out[s] for s in inn.get(k, ())) for k in out}
    return pr


def test_page_rank_matches_python_with_hot_source(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        edges = [(0, t) for t in range(1, 60)] + [(t, (t * 7) % 61) for t in range(1, 61)] + [(5, 6), (5, 6)]
        df = spark.createDataFrame(edges, "from_id long, to_id long")
        got = {r.doc_id: r.score for r in graph.page_rank(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    want = _py_pagerank(edges)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_page_rank_no_edges_is_empty(spark):
    df = spark.createDataFrame([], "from_id long, to_id long")
    assert graph.page_rank(df).count() == 0


def test_search_or_semantics_and_rule_a(spark):
    lex = spark.createDataFrame([(1, "red"), (2, "blue")], "word_id long, word string")
    inv = spark.createDataFrame([(1, 10), (1, 11), (2, 11), (2, 12)], "word_id long, doc_id long")
    ranks = spark.createDataFrame([(10, 0.5), (11, 0.25)], "doc_id long, score double")  # 12 has no rank
    q = spark.createDataFrame([(0, "Red  blue red"), (1, "green")], "query_id long, keywords string")
    got = [(r.query_id, r.rank, r.doc_id, r.score) for r in search.search(q, lex, inv, ranks).orderBy("rank").collect()]
    assert got == [(0, 1, 10, 1.0), (0, 2, 11, 0.75)]


def test_sinks_insert_if_absent_and_overwrite(spark):
    root = f"{ensure_checkpoint_dir(spark)}/test-index/{uuid.uuid4().hex}"
    first = spark.createDataFrame([(1, "a"), (2, "b")], "word_id long, word string")
    second = spark.createDataFrame([(2, "c"), (3, "a"), (4, "d")], "word_id long, word string")
    assert index_store.append_if_absent(spark, root, "lexicon", first, "word_id", "word").count() == 0
    skipped = index_store.append_if_absent(spark, root, "lexicon", second, "word_id", "word")
    assert sorted(r.word_id for r in skipped.collect()) == [2, 3]
    table = sorted((r.word_id, r.word) for r in index_store.read_index_table(spark, root, "lexicon").collect())
    assert table == [(1, "a"), (2, "b"), (4, "d")]
    ranks = spark.createDataFrame([(1, 0.5)], "doc_id long, score double")
    index_store.write_page_rank(ranks, root)
    index_store.write_page_rank(ranks, root)  # a second run replaces, never fails
    assert index_store.read_index_table(spark, root, "page_rank").count() == 1
    inv = spark.createDataFrame([(w, d) for w in range(1, 5) for d in range(w * 3)], "word_id long, doc_id long")
    index_store.write_postings(inv, root, buckets=4)
    import glob

    import pyarrow.parquet as pq

    files = glob.glob(f"{root.removeprefix('file:')}/inverted_index/bucket=*/*.parquet")
    assert files
    for f in files:
        rows = [(r["word_id"], r["doc_id"]) for r in pq.ParquetFile(f).read().to_pylist()]
        assert rows == sorted(rows)
    wanted = spark.createDataFrame([(2,), (4,)], "word_id long")
    got = index_store.read_postings(spark, root, wanted, buckets=4).groupBy("word_id").count().collect()
    assert sorted((r.word_id, r["count"]) for r in got) == [(2, 6), (4, 12)]


def test_page_rank_converged_reaches_fixed_point(spark):
    edges = [(t, (t * 7) % 41) for t in range(1, 41)] + [(t, (t * 3 + 1) % 41) for t in range(0, 41)]
    df = spark.createDataFrame(edges, "from_id long, to_id long")
    got = {r.doc_id: r.score for r in graph.page_rank(df, tol=1e-12, max_iterations=400).collect()}
    want = _py_pagerank(edges, sweeps=400)
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    with pytest.raises(graph.NotConverged) as stopped:
        graph.page_rank(df, tol=1e-12, max_iterations=10)
    assert stopped.value.sweeps == 10 and 0 < stopped.value.residual < 1


def _py_suggestions(queries, succeeded, shown=5):
    import re

    history = []  # (text, first_seen) in order of first success
    out = {}
    for qid, kw in sorted(queries):
        if qid in succeeded:
            text = succeeded[qid] or kw
            if text not in [t for t, _ in history]:
                history.append((text, qid))
            continue
        words = kw.split()
        if len(kw) == 1:
            pattern = "^" + re.escape(kw)
        elif not words:
            continue
        else:
            pattern = "^" + " +".join(re.escape(w[0]) + ".*" + re.escape(w[-1]) for w in words)
        hits = [t for t, _ in history if re.search(pattern, t)]
        if hits:
            out[qid] = hits[:shown]
    return out


def test_suggestions_match_python_regex(spark):
    queries = [(0, "That and onesen"), (1, "red blue"), (2, "Tat and oesen"), (3, "r"), (4, "(x y"),
               (5, "rd bue"), (6, "   "), (7, "(xy yy"), (8, "Tt"), (9, "The and onsen"), (10, "Tat")]
    succeeded = {0: None, 1: None, 7: None, 9: "the and onesen"}
    q = spark.createDataFrame(queries, "query_id long, keywords string")
    fb = spark.createDataFrame([(k, v, 1, 100 + k, 1.0) for k, v in succeeded.items()],
                               "query_id long, corrected string, rank long, doc_id long, score double")
    got = {}
    for r in search.suggestions(q, fb).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.suggestion)
    assert got == _py_suggestions(queries, succeeded)
    assert got[2] == ["That and onesen"] and got[3] == ["red blue"]


def test_seed_file_scan(spark, tmp_path):
    from webloom.operators.crawl import read_seed_file

    f = tmp_path / "seeds.txt"
    f.write_text("http://Localhost:8080/\n\n  HTTP://h.example/a#frag  \nhttp://h.example/a\n")
    got = sorted((r.url, r.depth) for r in read_seed_file(spark, str(f)).collect())
    assert got == [("http://Localhost:8080/", 0), ("http://h.example/a", 0)]


def test_recent_words_chunked_equals_single_chunk(spark):
    texts = ["a b c", "a d e f g h i j k", "l a", "b b b c", "m n o p q r s t", "a c e g i k m o q"]
    log = spark.createDataFrame([(1, i, t) for i, t in enumerate(texts)] + [(2, 0, "x y x")],
                                "user_id long, seq long, text string")
    one = sorted((r.user_id, r.rank, r.word) for r in history.recent_words(log).collect())
    many = sorted((r.user_id, r.rank, r.word) for r in history.recent_words(log, chunk_rows=3).collect())
    assert one == many
    q = []
    for word in " ".join(texts).split():
        q = q if word in q else (q + [word])[-10:]
    assert [w for u, _, w in one if u == 1] == list(reversed(q))


def _limit_ranks(rows, sweeps=400):
    out, links = {}, {}
    for a, _ in rows:
        out[a] = out.get(a, 0) + 1
    for a, b in set(rows):
        if b in out:
            links.setdefault(b, []).append(a)
    scores = {a: 1.0 / len(out) for a in out}
    for _ in range(sweeps):
        scores = {b: 0.15 / len(out) + 0.85 * sum(scores[a] / out[a] for a in links.get(b, [])) for b in out}
    return scores


def test_converged_ranks_take_few_sweeps(spark):
    """F2: the sum of scores is balanced, so 40 sweeps do for what took over 150."""
    r = random.Random(3)
    rows = [(a, r.randrange(300)) for a in range(300) for _ in range(12)] + [(a, 10_000 + a) for a in range(40)]
    df = spark.createDataFrame(rows, "from_id long, to_id long")
    got = {x.doc_id: x.score for x in graph.page_rank(df, initial_pr=1000.0, tol=1e-12, max_iterations=40).collect()}
    assert got == pytest.approx(_limit_ranks(rows), abs=1e-13)


def test_converged_ranks_with_a_hot_source_take_few_sweeps(spark):
    """the same where one source holds most links (salted sweeps)."""
    r = random.Random(4)
    rows = [(0, b) for b in range(1, 800)] + [(a, r.randrange(60)) for a in range(1, 60) for _ in range(6)]
    df = spark.createDataFrame(rows, "from_id long, to_id long")
    got = {x.doc_id: x.score for x in graph.page_rank(df, tol=1e-12, max_iterations=40).collect()}
    assert got == pytest.approx(_limit_ranks(rows), abs=1e-13)
