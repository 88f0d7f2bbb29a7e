import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from webloom.llm.packing import SumOfSquares, pack, pack_partition
from webloom.llm.token_files import decode_ranks, encode_ranks, read_token_files, tokens, write_token_files
from webloom.llm.token_pieces import Encoder, tokenizer_path

WORD, BYTE = "word_bpe_49k.json", "byte_bpe_50k.json"
ODD = ["a\n\nb  c\t d ", "  lead", "trail  ", "it's 'll  x's", "́a b́", "<|endoftext|> x<|endoftext|>", "İ ſ",
       "a\x1cb\x1d c", "x  y z", "1 234 5", "\r\n a \r\n", "a|b | c | d", "|", "a\nb", "", "\n", "x\x00y a\x00", "word." * 100]


@pytest.fixture(scope="module", params=[WORD, BYTE])
def own(request):
    return Encoder(tokenizer_path(request.param))


def test_word_by_word_equals_whole_texts(own):
    for text, ids in zip(ODD, own.encode_many(ODD), strict=True):
        assert np.array_equal(ids, own.whole(text)), repr(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aB'sé \n\t|.1́ ß$"), max_size=30), max_size=4))
def test_any_text(texts):
    for name in (WORD, BYTE):
        own = test_any_text.__dict__.setdefault(name, Encoder(tokenizer_path(name)))
        for text, ids in zip(texts, own.encode_many(texts), strict=True):
            assert np.array_equal(ids, own.whole(text)), repr(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300) | st.integers(0, 70_000)))
def test_control_bytes_round_trip(values):
    ranks = np.array(values, np.uint32)
    control, data = encode_ranks(ranks)
    assert len(control) == -(-len(values) // 4)
    assert decode_ranks(control, data, len(ranks)).tolist() == values


def test_token_files_round_trip(spark, messy, rows, nothing, tmp_path):
    library = Encoder(tokenizer_path(WORD))
    for blocks in (100, 1 << 16):
        path = str(tmp_path / f"files{blocks}")
        write_token_files(messy, path, tokenizer_path(WORD), 1, block_ids=blocks)
        got = [(r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in read_token_files(spark, path).orderBy("start").collect()]
        ids = [(i, np.append(library.whole(t or ""), np.uint32(1)).astype("<u4").tobytes()) for i, t, _ in rows]
        ids.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        start, expected = 0, []
        for i, b in ids:
            expected.append((i, start, len(b) // 4, b))
            start += len(b) // 4
        assert got == expected
    write_token_files(nothing, str(tmp_path / "none"), tokenizer_path(WORD), 1)
    assert read_token_files(spark, str(tmp_path / "none")).collect() == []


def checked(pieces, documents, window):
    """Every id in one piece, windows without gaps; the padding."""
    spans, fills = defaultdict(list), defaultdict(list)
    for row, start, length, crc, total, number, offset in pieces:
        ids = documents[row]
        assert total == len(ids) and zlib.crc32(ids[start : start + length].astype("<u4").tobytes()) == crc and length > 0
        spans[row].append((start, length))
        fills[number].append((offset, length))
    for row, ids in documents.items():
        at = 0
        for start, length in sorted(spans[row]):
            assert start == at
            at += length
        assert at == len(ids)
    assert sorted(fills) == list(range(len(fills)))
    padding = 0
    for pieces_ in fills.values():
        at = 0
        for offset, length in sorted(pieces_):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=80))
def test_packing_any_lengths(lengths):
    documents = {k: np.arange(k, k + n, dtype=np.uint32) for k, n in enumerate(lengths)}
    out = pack_partition(((k, k, x) for k, x in documents.items()), 64)
    assert checked([(r, s, n, c, t, w, o) for r, _, s, n, c, t, w, o in out], documents, 64) < 64


def test_the_level_with_the_smallest_sum_of_squares_is_chosen():
    levels, window = SumOfSquares(64), 64
    rng, opened = np.random.default_rng(1), 0
    for size in rng.integers(1, 64, 500).tolist():
        before = levels.counts.copy()
        cost = lambda c: int((levels.weight * c * c).sum())
        best = []
        for level in range(window - size + 1):
            if level == 0 or before[level]:
                after = before.copy()
                after[level] -= level > 0
                after[level + size] += level + size < window
                best.append((cost(after), -level))
        number, level = levels.place(size, opened)
        opened += number == opened
        assert (cost(levels.counts), -level) == min(best)


def test_pack_messy_rows(spark, messy, rows, nothing):
    library = Encoder(tokenizer_path(BYTE))
    got = pack(messy, tokenizer_path(BYTE), 0).collect()
    expected = sorted((str(i), np.append(library.whole(t or ""), np.uint32(0)).astype("<u4").tobytes()) for i, t, _ in rows)
    by_row = defaultdict(list)
    for r in got:
        by_row[r.row_id].append(r)
    assert len(by_row) == len(rows)
    documents, left = {}, list(expected)
    for row, pieces in by_row.items():
        pieces.sort(key=lambda r: r.start)
        for k, (i, b) in enumerate(left):
            if i == str(pieces[0].doc_id) and len(b) // 4 == pieces[0].doc_tokens and all(
                    zlib.crc32(b[4 * p.start : 4 * (p.start + p.length)]) == p.ids_crc32 for p in pieces):
                documents[row] = np.frombuffer(left.pop(k)[1], "<u4")
                break
    assert not left
    checked([(r.row_id, r.start, r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset) for r in got], documents, 1024)
    assert pack(nothing, tokenizer_path(BYTE), 0).collect() == []


def test_forgetting_rare_words_changes_no_ids(monkeypatch):
    from webloom.llm import token_pieces
    texts = [" ".join(f"w{k % (3 + j)} rare{j}x{k} the" for k in range(40)) for j in range(60)]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        own = token_pieces.Encoder(token_pieces.tokenizer_path(name))
        for most in (0, 10, 150):
            monkeypatch.setattr(token_pieces, "REMEMBERED", most)
            for at, text in enumerate(texts):
                got = list(own.encode_many([text, texts[0]]))
                assert got[0].tolist() == own.whole(text).tolist() and got[1].tolist() == own.whole(texts[0]).tolist(), (most, at)


@pytest.mark.parametrize("name", [WORD, BYTE])
def test_new_words_are_encoded_many_at_a_time(name):
    """First words of lines and all others go to the library together, not one call each."""
    own, calls = Encoder(tokenizer_path(name)), []
    whole = own.whole
    texts = ["\n".join(f"w{k}x{i}q {i}z" for i in range(50)) for k in range(40)]
    expected = [whole(t) for t in texts]
    own.whole = lambda text: calls.append(text) or whole(text)
    for ids, want in zip(own.encode_many(texts), expected, strict=True):
        assert np.array_equal(ids, want)
    assert len(calls) < 5


def test_a_text_with_a_very_long_word_is_encoded_whole_and_the_others_by_word():
    for name in (WORD, BYTE):
        own = Encoder(tokenizer_path(name))
        texts = ["ab cd", "x" * 201 + " ab only", "", "ab ef\ngh", "ab " + "y" * 500, " " * 3]
        for text, ids in zip(texts, own.encode_many(texts), strict=True):
            assert np.array_equal(ids, own.whole(text)), text[:20]
        assert not any("only" in word or len(word) > 201 for word in own.slots)


def test_ids_on_their_way_to_files_are_as_narrow_as_the_vocabulary(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"some words {i}" * 5) for i in range(50)], "doc_id long, text string")
    assert {(r.width, len(r.ids) % 2) for r in tokens(docs, tokenizer_path(WORD), 1).collect()} == {(2, 0)}
    assert {(r.width, len(r.ids) % 4) for r in tokens(docs, tokenizer_path(WORD), 70_000).collect()} == {(4, 0)}
    write_token_files(docs, str(tmp_path / "wide"), tokenizer_path(WORD), 70_000)
    own = Encoder(tokenizer_path(WORD))
    got = {r.doc_id: np.frombuffer(r.ids, "<u4") for r in read_token_files(spark, str(tmp_path / "wide")).collect()}
    assert all(np.array_equal(got[i], np.append(own.whole(f"some words {i}" * 5), 70_000)) for i in range(50))


def test_words_that_differ_in_case_and_signs_behind_them_are_encoded_once():
    """Lower-casing and cutting before signs changes no ids, whatever stands around them."""
    own = Encoder(tokenizer_path(WORD))
    assert own.apart and not Encoder(tokenizer_path(BYTE)).apart
    words = ["tale", "Tale", "TALE,", "tale.", "tale!!", "(tale)", "don't", "DON'T,", "it's", "'s", "a,b,c", "x<\u0338y", "a<\u0338b", "e\u0301,", "E\u0301.",
             "\u00c9t\u00e9,", "\u0130z.", "\u03a3\u0391\u03a3,", "\u03a3.a", "3,4", "n3.", "a_b", "a||b", "|", "tale|", "<|endoftext|>,", "\u4e2d\u6587,", "a\u0327,b"]
    texts = [*words, " ".join(words), "".join(words), " ".join(reversed(words)), ",".join(words)]
    for got, text in zip(own.encode_many(texts), texts, strict=True):
        assert got.tolist() == own.whole(text).tolist(), text
    seen = []
    own._learn, learn = lambda: seen.extend(own.slots.new) or learn(), own._learn
    list(own.encode_many(["novel Novel NOVEL, novel! (novel"]))
    assert sorted(set(seen) - {",", "!"}) == ["(novel", "novel"]
