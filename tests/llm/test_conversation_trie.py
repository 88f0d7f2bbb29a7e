"""The trie against a plain one built conversation by conversation."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from webloom.llm import conversation_trie as T
from webloom.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, depth string, key string, place string, n string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).digest(), text or ""))
    turns = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c - 5 * int(c / 5))
        seq = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = Counter(s[:-1] for s in members if s)
    leaves, saved = Counter(), Counter()
    for s, m in members.items():
        cost = (len(m) - 1) * len(s[-1][1].encode()) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += s not in children
            saved[s[:d]] += cost
    return Counter(
        (min(m), len(s), min(members[s[:-1]]) if s else None, len(m), children[s], leaves[s], saved[s],
         hashlib.sha256(",".join(map(str, sorted(ends.get(s, [])))).encode()).hexdigest()) for s, m in members.items())


def check(spark, rows):
    df = spark.createDataFrame([(*r, "d", "k", "p", "n") for r in rows], SCHEMA).repartition(4)
    assert Counter(map(tuple, T.trie(df).collect())) == brute(rows)


def conversations(seed, n, words):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(1, 12)):
            rows.append((c, r.choice([t, t, t, None, 1]), r.choice(["user", "assistant", None, ""]), r.choice(words)))
    return rows


def test_many_shared_prefixes(spark):
    check(spark, conversations(1, 300, ["a", "b", "é", None, ""]))


def test_messy_rows(spark):
    rows = conversations(2, 40, ["one", "two\nlines", "", None, "x" * 50_000, "ü" * 7])
    rows += [(None, 1, "user", "lost"), (None, None, None, None), (10**15 + 3, 1, "user", "far"), (10**15, 1, "user", "base"),
             (-7, 1, "user", "below"), (-5, 0, "user", "base below"), (4, None, None, None)] + rows[:5]
    check(spark, rows)


def test_hot_sequence_and_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(T, "PIECE", 16)
    same = [(c * 5, t, "user", f"line {t}") for c in range(1500) for t in range(3)]
    long = [(10_000, t, "user", f"turn {t % 50}") for t in range(150)] + [(10_001, t, "user", f"turn {t % 50}") for t in range(140)]
    check(spark, same + [(c, 0, "user", "line 0") for c in range(8000, 8100)] + long)


def test_empty_table(spark):
    assert T.trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_and_its_sql(spark):
    got = QUERIES["op12_conversation_trie"](spark, "/root/testdata/sf0.001")
    duck = duckdb.connect()
    duck.execute("CREATE VIEW conversations AS FROM '/root/testdata/sf0.001/conversations.parquet'")
    rows = duck.execute("SELECT conv_id, turn, role, text FROM conversations").fetchall()
    told = duck.execute(ORACLE_SQL["op12_conversation_trie"])
    names = [d[0] for d in told.description]
    assert names == got.columns
    assert Counter(map(tuple, got.collect())) == Counter(told.fetchall()) == brute(rows)
