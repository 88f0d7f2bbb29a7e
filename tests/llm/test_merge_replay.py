"""Merge replay gives the ids of the tiktoken library, and they decode to the texts."""

import base64
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from webloom.llm import merge_replay as M
from webloom.llm.queries import RANK_FILE, QUERIES
from webloom.llm.token_pieces import tokenizer_path, word_pattern

PATH = tokenizer_path(RANK_FILE)


def library(path):
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


@pytest.fixture(scope="module")
def public():
    return library(PATH)


def ids_of(text, ranks, split):
    words = split.words(text)
    assert "".join(words) == text
    return [int(i) for w in M.replay([w.encode() for w in words], ranks) for i in w]


def test_texts_of_many_scripts(public):
    ranks, split, r = M.Ranks(PATH), M.Splitter(word_pattern()), random.Random(4)
    letters = "aaaabcde 's't 12!?\n\t \r éüß中文字ñ\'llxyz\u0558֋٣  \x85ᲊ\ua7ce\U00010d4a\U000323b0\U0001fae9\x00"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 50))) for _ in range(4000)]
    for text in [*texts, "a" * 3000, "ab" * 2000 + " " * 500, "", "<|endoftext|>"]:
        assert ids_of(text, ranks, split) == public.encode_ordinary(text), text


def test_rank_files_that_are_not_closed_under_merging(tmp_path):
    """A merge may make a pair of lower rank; the library's order of merges is kept."""
    r, split = random.Random(5), M.Splitter(word_pattern())
    for k in range(400):
        extra = sorted({bytes(r.choice(b"abc") for _ in range(r.randint(2, 5))) for _ in range(r.randint(1, 25))})
        table = [bytes([b]) for b in range(256)] + r.sample(extra, len(extra))
        path = tmp_path / f"{k}.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(table)))
        ranks, own = M.Ranks(str(path)), library(path)
        words = ["".join(r.choice("abc") for _ in range(r.randint(1, 30))) for _ in range(10)]
        for word, ids in zip(words, M.replay([w.encode() for w in words], ranks), strict=True):
            assert ids.tolist() == own.encode_ordinary(word) == ids_of(word, ranks, split)


def expected(rows, public):
    out = Counter()
    for doc_id, text in rows:
        ids = public.encode_ordinary(text or "")
        out[doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("chunk_chars", [1, 3000, M.CHUNK_CHARS])
def test_messy_rows(spark, messy, rows, public, chunk_chars, monkeypatch):
    monkeypatch.setattr(M.chunks, "__defaults__", (chunk_chars,))
    coded = M.encode(messy, PATH, word_pattern())
    got = Counter(map(tuple, M.digests(coded, PATH).collect()))
    assert got == expected([(i, t) for i, t, _ in rows], public)
    texts = Counter((r.doc_id, bytes(r.bytes)) for r in M.decode(coded, PATH).collect())
    assert texts == Counter((i, (t or "").encode()) for i, t, _ in rows)


def test_both_sides_read_one_exchange(spark, small, capsys):
    coded = M.encode(small, PATH, word_pattern())
    coded.collect()
    coded.explain()
    assert "ReusedExchange" in capsys.readouterr().out


def test_query_over_whole_table(spark, small, public):
    got = QUERIES["op11_merge_replay"](spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter(map(tuple, got.collect())) == expected([(r.doc_id, r.text) for r in small.collect()], public)


def test_empty_table(spark, nothing):
    assert M.decode(M.encode(nothing, PATH, word_pattern()), PATH).count() == 0


def test_index_touches_only_neighbours():
    """Words do not reach into each other: coding them together or alone gives the same ids."""
    ranks, r = M.Ranks(PATH), random.Random(6)
    words = ["".join(r.choice("thean ior") for _ in range(r.randint(1, 12))).encode() for _ in range(2000)]
    together = M.replay(words, ranks)
    assert all(np.array_equal(M.replay([w], ranks)[0], t) for w, t in zip(words[:200], together, strict=False))
