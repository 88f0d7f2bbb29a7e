import zlib
from collections import defaultdict
from itertools import pairwise

from webloom.llm.sharding import shard


def check(got, pairs, shards=8):
    assert len(got) == len(pairs)
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs)
    slots, sizes = defaultdict(list), [0] * shards
    for r in got:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    groups = defaultdict(lambda: [10**18, 0])
    for i, t in pairs:
        g = groups[t or ""]
        g[0], g[1] = min(g[0], -(10**17) if i is None else i), g[1] + len((t or "").encode()) + 1
    return sizes, groups


def smallest(group_sizes, shards):
    def fits(c):
        used, room = 1, c
        for g in group_sizes:
            if g > room:
                used, room = used + 1, c
            room -= g
        return used <= shards
    low, high = max(group_sizes), sum(group_sizes)
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if fits(mid) else (mid + 1, high)
    return low


def test_documents_are_cut_at_the_smallest_capacity(small):
    pairs = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    sizes, groups = check(shard(small).collect(), pairs)
    assert max(sizes) <= smallest([g for _, g in sorted(map(tuple, groups.values()))], 8)
    assert min(sizes) > 0


def test_equal_texts_share_a_shard(messy, rows):
    got = shard(messy)
    check(got.collect(), [(i, t) for i, t, _ in rows])
    by_text = defaultdict(set)
    for r in got.collect():
        by_text[(r.size, r.text_crc32)].add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())


def test_a_hot_group_leaves_the_others_spread(spark):
    df = spark.range(600).selectExpr("id AS doc_id", "if(id % 2 = 0, repeat('x', 99), concat(repeat('y', 90), id)) AS text")
    sizes, _ = check(shard(df).collect(), [(r.doc_id, r.text) for r in df.collect()])
    assert max(sizes) == 300 * 100 and min(sizes) > 2500


def test_empty_table_and_one_row(spark, nothing):
    assert shard(nothing).collect() == []
    one = spark.createDataFrame([(7, None)], "doc_id long, text string")
    assert [(r.size, r.text_crc32, r.slot) for r in shard(one).collect()] == [(1, 0, 0)]


def test_cuts_are_in_order(small):
    got = shard(small, shards=5).groupBy("shard").agg({"doc_id": "min"}).orderBy("shard").collect()
    assert all(a.shard < b.shard for a, b in pairwise(got))
