import random
from difflib import SequenceMatcher

import pytest
from webloom.llm.fingerprints import PIECES, Powers, PrefixHashes, aligned_likeness, fingerprint, likeness
from webloom.llm.queries import op2_fingerprints


def prose(r, n):
    vocabulary = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(300)]
    return " ".join(r.choice(vocabulary) for _ in range(n))


def near(a, b):
    powers = Powers()
    return aligned_likeness(PrefixHashes(a, powers), PrefixHashes(b, powers))


def brute(a, b):
    return sum(m.size for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()) / max(len(a), len(b), 1)


@pytest.mark.parametrize("k", [2, 3, 5, 10])
def test_scattered_insertions_match_brute_force(k):
    r = random.Random(k)
    for _ in range(5):
        a = prose(r, 250)
        words = a.split(" ")
        for at in r.sample(range(len(words)), k):
            words[at] += "s"
        b = " ".join(words)
        assert near(a, b) >= min(brute(a, b), len(a) / len(b)) - 0.01 and near(b, a) >= 0.95


def test_ends_moves_and_strangers():
    r = random.Random(1)
    a, b = prose(r, 300), prose(random.Random(2), 300)
    assert near(a, "!" + a + "?") > 0.99 and near(a, a) == 1
    assert near(a, a[:500] + b[:400] + a[500:]) == pytest.approx(len(a) / (len(a) + 400), abs=0.01)
    assert near(a, b) < 0.1 and near("", "") == 1 and near("", "a") == 0 and near("ab", "ba") <= 0.5
    assert near("ab" * 3000, "x" + "ab" * 3000) > 0.99


def test_the_query_sees_near_copies(spark, tmp_path):
    a = prose(random.Random(5), 400)
    words = a.split(" ")
    for at in (40, 120, 200, 280, 360):
        words[at] += "s"
    rows = [(2, a), (1, " ".join(words)), (0, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x for x in op2_fingerprints(spark, str(tmp_path)).collect()}
    assert got[2].near_next > 0.9 and got[1].near_next == 0
    assert got[2].near_next == likeness(got[2].fingerprint, got[1].fingerprint)


@pytest.mark.parametrize("k", [1, 2, 3, 5, 10])
@pytest.mark.parametrize("words", [250, 1500])
def test_fingerprints_see_scattered_insertions(k, words):
    """At most about two pieces are lost to an edit, on average one and a half."""
    r, powers = random.Random(k), Powers()
    short = 0.0
    for _ in range(10):
        a = prose(r, words)
        changed = a.split(" ")
        for at in r.sample(range(len(changed)), k):
            changed[at] += "s"
        b = " ".join(changed)
        got = likeness(fingerprint(a, powers), fingerprint(b, powers))
        assert got == likeness(fingerprint(b, powers), fingerprint(a, powers)) <= 1
        short += brute(a, b) - got if words < 1000 else 1 - k / len(b) - got
    assert short / 10 <= 2.5 * k * 2 / PIECES + 0.01


def test_fingerprints_of_texts_of_other_sizes_and_of_strangers():
    r, powers = random.Random(3), Powers()
    a, b = prose(r, 800), prose(random.Random(4), 900)
    fp = lambda t: fingerprint(t, powers)
    assert likeness(fp(a), fp(b)) < 0.1
    for part in (0.9, 0.45, 0.2):  # the longer text is sampled more coarsely
        cut = a[: int(len(a) * part)] + "!"
        assert part - 0.08 <= likeness(fp("??" + a), fp(cut)) <= part + 0.01
    assert likeness(fp("ab" * 3000), fp("x" + "ab" * 3000)) > 0.98
    assert likeness(fp("x"), fp("xy")) <= 0.5 and likeness(fp("日本語" * 40), fp("日本語" * 40 + "。")) > 0.9
