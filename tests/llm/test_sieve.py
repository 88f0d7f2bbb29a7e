"""Rows that meet under a rare key are sifted by a broadcast bit table, so that the others do not move for the join."""

from pyspark.sql import functions as F

from webloom.llm import ngram_join
from webloom.llm.common import sifted
from webloom.llm.line_dedup import _within


def test_sifted_rows_hold_all_wanted_and_few_others(spark):
    rows = spark.range(20000).select((F.col("id") * 7919).alias("k"), F.col("id").alias("v"))
    wanted = spark.createDataFrame([(7919 * i,) for i in (0, 5, 19999)], "k long")
    got = {r["v"] for r in sifted(rows, "k", wanted).collect()}
    assert {0, 5, 19999} <= got and len(got) < 40


def test_signatures_of_one_document_are_not_moved_for_the_join(spark, monkeypatch):
    plans, real = [], ngram_join.materialize

    def told(df):
        if df.columns[:2] == ["sig", "node"]:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df)

    monkeypatch.setattr(ngram_join, "materialize", told)
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "quite another text of a few words"), (4, None)], "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = sorted((r["doc_id"], r["component_id"]) for r in ngram_join.ngram_components(docs).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [(1, 1), (2, 1), (3, 3), (4, 4)]
    assert "BroadcastHashJoin" in plans[0]


def test_whole_lines_are_judged_as_by_pieces(spark):
    base = " ".join(f"word{i}" for i in range(40))
    rows = [(base, base.replace("word7 ", "")), (base, base[: len(base) // 2]), (base, base[::-1]), ("a b", "a c"), (base, base)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)], "k int, a string, b string").withColumn("n", F.greatest(F.length("a"), F.length("b")))
    got = df.select("k", _within("a", "b", "n", "n").alias("x"), _within("a", "b", "n", "n", pieced=False).alias("y")).orderBy("k").collect()
    assert [r["x"] for r in got] == [r["y"] for r in got] == [True, False, False, False, True]
