import hashlib
from collections import defaultdict

from webloom.llm.exact_dedup import exact_dedup

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[(t or "").translate(LOWER)].append(i)
    out = []
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def test_messy_rows_match_brute_force_at_any_digit_size(messy, rows):
    for first, growth in ((64, 8), (1, 2), (7, 3)):
        got = sorted(map(tuple, exact_dedup(messy, first_digit=first, growth=growth).collect()), key=str)
        assert got == brute([(i, t) for i, t, _ in rows])


def test_documents_match_brute_force(small):
    got = sorted(map(tuple, exact_dedup(small).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()])


def test_empty_table(nothing):
    assert exact_dedup(nothing).collect() == []


def test_a_hot_group_of_copies(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 = 0, repeat('copy ', 400), concat(repeat('copy ', 300), id)) AS text")
    got = exact_dedup(df)
    assert got.where("group_size = 1000").count() == 1000
    assert got.where("kept").count() == 2001
    assert {r.keep_id for r in got.where("group_size = 1000").collect()} == {2997}
