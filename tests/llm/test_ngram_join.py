from itertools import combinations

import numpy as np
import pytest

from webloom.llm.components import connected_components
from webloom.llm.ngram_join import Bands, link_by_groups, ngram_components, parity_sketch, signatures, token_set

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, n):
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(pairs, n, percent):
    sets = [shingles(t, n) for _, t in pairs]
    ids = [-(1 << 63) if i is None else i for i, _ in pairs]
    root = list(range(len(pairs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(pairs)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), i), i)
    return sorted((i, len(s), least[find(k)]) for k, (i, s) in enumerate(zip(ids, sets, strict=True)))


def result(df, **options):
    return sorted(map(tuple, ngram_components(df, **options).collect()))


def family(seed, copies, words=60, edits=2):
    rng = np.random.default_rng(seed)
    base = [f"w{x}" for x in rng.integers(0, 10_000, words)]
    for _ in range(copies):
        text = list(base)
        for at in rng.integers(0, words, edits):
            text[at] = f"x{rng.integers(0, 10_000)}"
        yield " ".join(text)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_messy_rows_match_brute_force(messy, rows, n, percent):
    assert result(messy, words=n, percent=percent) == brute([(i, t) for i, t, _ in rows], n, percent)


def test_families_over_many_partitions_match_brute_force(spark):
    texts = [t for seed in range(4) for t in family(seed, 40, 60, 1 + seed % 2)]
    chain = [f"c{k}" for k in range(100)]
    texts += [" ".join(chain[:k] + [f"d{j}" for j in range(k, 100)]) for k in range(0, 101, 5)]
    pairs = list(enumerate(texts))
    df = spark.createDataFrame(pairs, "doc_id long, text string")
    expected = brute(pairs, 3, 90)
    assert result(df, words=3, percent=90) == expected
    assert result(df, words=3, percent=90, partition_bytes=3000) == expected


def test_empty_table(nothing):
    assert ngram_components(nothing).collect() == []


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for percent in (75, 80, 90, 95):
        bands = Bands(percent)
        for size in [*range(1, 60), 97, 150, 333, 1000]:
            common = rng.integers(0, 1 << 63, size).astype(np.uint64)
            for extra_a in range(0, size // 3 + 1, max(1, size // 12)):
                for extra_b in (0, extra_a // 2, extra_a):
                    if 100 * size < percent * (size + extra_a + extra_b):
                        continue
                    a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, k).astype(np.uint64)])) for k in (extra_a, extra_b))
                    if not np.array_equal(a, b):
                        assert np.intersect1d(signatures(a, bands), signatures(b, bands)).size


def test_groups_find_what_pairs_find():
    texts = [t for seed in range(6) for t in family(seed, 30, 50, seed)]
    sets = [token_set(t, 3) for t in texts]
    for group in (1, 8, 500):
        labels = link_by_groups(sets, np.arange(len(sets)), 80, group=group)
        expected = np.arange(len(sets))
        for a, b in combinations(range(len(sets)), 2):
            shared = np.intersect1d(sets[a], sets[b]).size
            if 100 * shared >= 80 * (len(sets[a]) + len(sets[b]) - shared):
                expected[expected == max(expected[a], expected[b])] = min(expected[a], expected[b])
        assert labels.tolist() == expected.tolist()


def test_components_of_paths_stars_and_nothing(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(10, 40)] + [(40, 10), (5, 5)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {k: 100 for k in range(100, 161)} | {k: 7 for k in [7, *range(10, 41)]} | {5: 5}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize("n", [2, 5, 12, 13])
def test_chunks_of_a_family_meet_in_rounds_that_move_a_set_twice(spark, monkeypatch, n):
    """Every two chunks meet, in as many rounds as each of them needs for two others at a time."""
    from pyspark.sql import functions as F

    from webloom.llm import ngram_join

    rng, far = np.random.default_rng(n), n // 2
    sets = [np.unique(rng.integers(1, 1 << 62, 40).astype(np.uint64)) for _ in range(far)]
    sets = [np.unique(np.append(sets[k % far], np.uint64(k + 1))) for k in range(n)]  # k and k + n // 2 are linked
    held = spark.createDataFrame([(k, int(s.view(np.int64)[0]), bytearray(s.tobytes())) for k, s in enumerate(sets)], "node long, least long, tokens binary")
    rows = spark.createDataFrame([(7, k, 0, n - 1, k, k) for k in range(n)], "family long, part int, low int, high int, node long, label long")
    rounds, write = [], ngram_join.materialize
    monkeypatch.setattr(ngram_join, "materialize", lambda df: rounds.append(df.columns) or write(df))
    total = sum(8 * len(s) for s in sets)
    links = ngram_join._across(rows, held, 90, -(-total // n)).select(F.least("a", "b"), F.greatest("a", "b")).distinct().collect()
    assert rounds.count(["a", "b"]) == max(1, n // 2)
    assert {k % far for pair in links for k in pair} == set(range(far)) and all(a % far == b % far for a, b in links)
    labels = {r.node: r.label for r in connected_components(spark.createDataFrame([tuple(x) for x in links], "a long, b long")).collect()}
    assert labels == {k: k % far for k in range(n)}


def signed_rows(spark, sets, percent):
    """Sets as the table that families are found in."""
    bands = Bands(percent)
    found = [(k, len(s), parity_sketch(s, percent).tolist(), signatures(s, bands).view(np.int64).tolist()) for k, s in enumerate(sets)]
    return spark.createDataFrame(found, "node long, n long, parity array<long>, signatures array<long>")


def test_sketches_never_part_linked_sets_and_part_most_others():
    rng = np.random.default_rng(5)
    for percent in (75, 80, 90, 100):
        for size in (1, 5, 40, 300, 3000, 60_000):
            common = rng.integers(0, 1 << 63, size).astype(np.uint64)
            for a_more, b_more in ((0, 0), (size // 9, 0), (size // 20, size // 20), (size // 4, 0)):
                a, b = (np.unique(np.append(common, rng.integers(0, 1 << 63, k).astype(np.uint64))) for k in (a_more, b_more))
                x, y = parity_sketch(a, percent), parity_sketch(b, percent)
                if len(x) > len(y):
                    x = np.bitwise_xor(x[: len(x) // 2], x[len(x) // 2 :])
                assert len(x) == len(y)
                assert np.bitwise_count((x ^ y).view(np.uint64)).sum() <= len(np.setxor1d(a, b))


def test_chance_meetings_under_a_signature_make_no_family(spark):
    """Texts that share one passage agree on some part, yet only copies may be linked."""
    from webloom.llm.ngram_join import _families

    rng = np.random.default_rng(9)
    common = rng.integers(0, 1 << 63, 150).astype(np.uint64)
    sets = [np.unique(np.append(common, rng.integers(0, 1 << 63, 300).astype(np.uint64))) for _ in range(60)]
    sets += [np.unique(np.append(s[:-5], rng.integers(0, 1 << 63, 5).astype(np.uint64))) for s in sets[:20]]
    signed = signed_rows(spark, sets, 80)
    held = [set(r.signatures) for r in signed.collect()]
    assert sum(bool(held[0] & h) for h in held[1:60]) > 10  # they do meet
    found = {}
    for r in _families(signed, 80).collect():
        found.setdefault(r.family, set()).add(r.node)
    assert sorted(map(sorted, found.values())) == [[k, k + 60] for k in range(20)]


@pytest.mark.parametrize("cell", [4096, 3])
def test_near_copies_of_a_part_that_differ_from_its_least_document_meet(spark, monkeypatch, cell):
    """Documents far from the least one of their part, but near each other, are linked, by few links however many they
    are; repeated rows do no harm."""
    from webloom.llm import ngram_join

    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 62, 300).astype(np.uint64)) for _ in range(3)]
    sets += [np.append(s[1:], s[-1:] + np.uint64(k)) for k in range(1, 8) for s in sets[1:]]
    rows = [(k, len(s), parity_sketch(s, 80).tolist(), [77]) for k, s in enumerate(sets)]
    signed = spark.createDataFrame([*rows, rows[4]], "node long, n long, parity array<long>, signatures array<long>")
    monkeypatch.setattr(ngram_join, "CELL", cell)
    assert sorted(map(tuple, ngram_join._families(signed, 80).collect())) == [(k, 2 - k % 2) for k in range(1, len(sets))]
    found = ngram_join.link_by_sketches([np.array(r[2]) for r in rows], np.array([r[1] for r in rows]), np.arange(len(rows)), 80)
    assert len(found) == len(sets) - 3
