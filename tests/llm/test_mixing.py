import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from webloom.llm.mixing import mix


def water(sizes, weights, epochs=3.0):
    total, clamped = sum(sizes.values()), {}
    while True:
        free = {s: w for s, w in weights.items() if s not in clamped}
        if not free:
            return clamped
        level = (total - sum(clamped.values())) / sum(free.values())
        over = {s: epochs * sizes[s] for s, w in free.items() if w * level >= epochs * sizes[s]}
        if not over:
            return clamped | {s: w * level for s, w in free.items()}
        clamped |= over


def check(df, rows, slack):
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    targets = water(sizes, {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(order)})
    taken = defaultdict(int)
    got = mix(df, out="times").select("doc_id", "text", "source", "times", "times_target", "times_source_size").collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.times <= 3 and r.times_source_size == sizes[r.source]
        assert r.times_target == pytest.approx(targets[r.source])
        taken[r.source] += r.times * words(r.text)
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= slack(s), (s, taken[s], targets[s])


def test_messy_rows(messy, rows):
    longest = defaultdict(int)
    for _, t, s in rows:
        longest[s] = max(longest[s], len((t or "").split()))
    check(messy, rows, lambda s: 3 * longest[s])  # rows that repeat an id are taken alike


def test_documents_come_near_their_targets_and_reruns_agree(small):
    rows = [(r.doc_id, r.text, r.source) for r in small.collect()]
    longest = max(len(t.split()) for _, t, _ in rows)
    check(small, rows, lambda s: longest)
    again = [mix(small.repartition(n)).select("doc_id", "repeats").orderBy("doc_id").collect() for n in (1, 5)]
    assert again[0] == again[1]


def test_many_equal_sized_documents_hit_the_target(spark):
    df = spark.range(9000).selectExpr("id AS doc_id", "'a b c' AS text", "if(id % 3 = 0, 'x', if(id % 90 = 1, 'y', null)) AS source")
    r = mix(df).groupBy("source").agg(F.sum(F.col("repeats") * 3).alias("taken"), F.first("repeats_target").alias("target"))
    assert all(abs(x.taken - x.target) <= 3 for x in r.collect())


def test_empty_and_wordless_tables(spark, nothing):
    assert mix(nothing).collect() == []
    df = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.repeats, r.repeats_target) for r in mix(df).collect()] == [(0, 0.0), (0, 0.0)]
