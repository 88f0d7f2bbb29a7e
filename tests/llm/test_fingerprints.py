import hashlib

import pytest

from webloom.llm.fingerprints import Powers, PrefixHashes, fingerprint, likeness, neighbour_fingerprints


def neighbours(pairs):
    ordered = sorted(((-(1 << 63) if i is None else i), t or "") for i, t in pairs)
    ordered.sort(key=lambda x: (-x[0], x[1]))
    for k, (i, t) in enumerate(ordered):
        nxt = ordered[(k + 1) % len(ordered)][1]
        m = len(t) // 3
        yield i, t, nxt, t[: len(t) - m] + nxt[:m]


@pytest.mark.parametrize("block", [200, 1 << 20])
def test_messy_rows_match_brute_force(messy, rows, block):
    powers = Powers()
    expected = []
    for i, t, nxt, new in neighbours([(i, t) for i, t, _ in rows]):
        a, b, c = (fingerprint(x, powers) for x in (t, new, nxt))
        expected.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), a, b, likeness(a, b), likeness(a, c)))
    got = list(map(tuple, neighbour_fingerprints(messy, block_bytes=block).collect()))
    assert sorted(got) == sorted(expected)


def test_spans_and_common_extensions_match_the_texts():
    powers = Powers()
    a, b = "abracadabra abracadabra", "xxabracadabra abrXcadabra"
    pa, pb = PrefixHashes(a, powers), PrefixHashes(b, powers)
    for i in range(len(a)):
        for j in range(len(b)):
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            assert pa.common_extension(i, pb, j) == n
            assert pa.same(i, pb, j, n)


def test_likeness():
    powers = Powers()
    fp = lambda t: fingerprint(t, powers)
    text = "".join(chr(97 + i * i * 7 % 26) for i in range(6000))
    assert likeness(fp(text), fp(text)) == 1 and fp(text) == fp(str(text))
    assert likeness(fp(""), fp("")) == 1 and likeness(fp(""), fp("a")) == 0
    assert likeness(fp(text), fp(text[:3000] + "!" + text[3000:])) > 0.95
    assert likeness(fp(text), fp(text[:4000] + text[4000:][::-1])) == pytest.approx(2 / 3, abs=0.03)
    assert likeness(fp(text), fp("z" * 6000)) < 0.05


def test_one_document_and_none(spark, nothing):
    one = spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")
    r = neighbour_fingerprints(one).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and r.near_next == 1
    assert neighbour_fingerprints(nothing).collect() == []
