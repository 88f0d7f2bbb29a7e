"""Recent words in many chunks and sign-outs over many partitions, against plain folds."""

import random

import pytest

from webloom.operators import history


def fold(words, queue=()):
    q = list(queue)
    for w in words:
        if w not in q:
            q = [*q, w][-10:]
    return q


def spoken(r, n, vocabulary):
    return [" ".join(r.choice(vocabulary) for _ in range(r.randint(1, 9))) for _ in range(n)]


@pytest.mark.parametrize("vocabulary", [list("abcdefghijk"), list("abcdefghijklmnopqrstuvwxyz"), [f"w{i}" for i in range(300)]])
def test_chunks_folded_at_once_are_repaired(spark, vocabulary):
    """Small vocabularies keep queues apart for long: eleven words in turn, for one."""
    r = random.Random(len(vocabulary))
    logs = {1: spoken(r, 120, vocabulary), 2: [" ".join(vocabulary)] * 40, 3: ["one"], 4: spoken(r, 30, vocabulary)}
    rows = [(u, s, t) for u, texts in logs.items() for s, t in enumerate(texts)]
    r.shuffle(rows)
    log = spark.createDataFrame(rows, "user_id long, seq long, text string")
    got = {}
    for x in history.recent_words(log, chunk_rows=25).orderBy("user_id", "rank").collect():
        got.setdefault(x.user_id, []).append(x.word)
    assert got == {u: fold(" ".join(texts).split())[::-1] for u, texts in logs.items()}


def test_queues_carried_in(spark):
    before = spark.createDataFrame([(1, ["x", "y"]), (2, ["kept"])], history.QUEUE_SCHEMA)
    words = spark.createDataFrame([(1, 0, k, w) for k, w in enumerate("abxcyd")] + [(3, 0, 0, "new")],
                                  "user_id long, seq long, pos int, word string")
    got = {x.user_id: x.queue for x in history.advance_queues(words, before, chunk_rows=2).collect()}
    assert got == {1: fold("abxcyd", ["x", "y"]), 2: ["kept"], 3: ["new"]}


def test_sign_outs_across_partitions(spark, monkeypatch):
    monkeypatch.setattr(history, "target_partitions", lambda df: 16)
    r = random.Random(2)
    log = [(7, s, r.choice(["a b", "b c", "c d e"])) for s in range(400)] + [(u, s, "x y") for u in range(20, 40) for s in range(3)]
    outs = [(7, 90), (7, 91), (7, 350), (21, 1), (22, 0), (22, 2), (99, 5)]
    got = {tuple(x) for x in history.history_snapshot(
        spark.createDataFrame(log, "user_id long, seq long, text string").repartition(5),
        spark.createDataFrame(outs, "user_id long, seq long")).collect()}
    want = set()
    for user in {u for u, _, _ in log}:
        marks = sorted(s for u, s in outs if u == user)
        for k, m in enumerate(marks):
            words = [w for u, s, t in sorted(log) if u == user and (marks[k - 1] if k else -1) < s <= m for w in t.split()]
            recent = fold(words)[::-1]
            want |= {(user, m, w, words.count(w), recent.index(w) + 1 if w in recent else None) for w in words}
    assert got == want
