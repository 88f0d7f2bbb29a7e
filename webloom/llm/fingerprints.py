"""Document fingerprints from prefix polynomial hashes.

A prefix array holds, for every position of a text, the polynomial hash of what lies before it, modulo a prime
and for two bases. The difference of two entries is the hash of the span between them, so any two spans are
compared in constant time, and the longest common extension of two positions is found by binary search.

A fingerprint samples the prefix array: at a fixed stride from the front (prefixes) and at the same stride from
the back (suffixes), and at places that the text itself picks: wherever the hash of the characters just before ends
in enough zeros. Such places move with the text, so behind an edit that changes the length the pieces between them
are the same again. Two fingerprints tell how far the texts agree from the front, from the back, in blocks at equal
distance from an end, and in pieces that follow each other in both; ``likeness`` is the part of the longer text that
agrees. A piece with an edit in it counts as different, so ``likeness`` is at most about a piece per edit too low.
Where both texts are at hand, ``matched`` aligns them character by character by their prefix arrays.

The query form compares each text with its next document and with an edited text that takes in the head of that
document. Neighbours meet without a global sort in one task: ids are cut into consecutive blocks of bounded
text size, each block also gets the first row of the following one, and a task walks through its block in order.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.session import target_partitions

#: The Mersenne prime 2^31 - 1 and two bases below it.
PRIME = (1 << 31) - 1
BASES = (1_000_003, 998_244_353)
#: Samples per direction: the stride is the least power of two that needs no more.
SAMPLES = 64
#: Characters whose hash picks a place, and pieces that a text is cut into on average at most.
PICK, PIECES = 8, 256
#: Lengths of the spans by which texts are brought together again after an edit, tried one after the other; equal
#: spans looked at on either side of a span's own place, where a text repeats itself.
WINDOWS, PLACES = (256, 64, 16, 6), 2
#: Characters of a gap, in either text, up to which the shortest spans are tried: in longer ones they agree by chance.
SHORT_GAP = 128
#: UTF-8 bytes of text in a block of neighbours.
BLOCK_BYTES = 8 << 20


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for x below 2^62."""
    x = (x & PRIME) + (x >> np.uint64(31))
    x = (x & PRIME) + (x >> np.uint64(31))
    return np.where(x >= PRIME, x - np.uint64(PRIME), x)


def _below(x: np.ndarray) -> np.ndarray:
    """Something congruent to x modulo PRIME and below 2^32, for x below 2^62: enough before sums are taken."""
    return (x & PRIME) + (x >> np.uint64(31))


class Powers:
    """Powers of the bases (or of their inverses) modulo PRIME, grown on demand."""

    def __init__(self, bases: tuple[int, ...] = BASES) -> None:
        self.bases, self.table = bases, np.ones((len(bases), 1), np.uint64)
        self.inverse = Powers((pow(bases[0], -1, PRIME),)) if bases is BASES else None

    def up_to(self, n: int) -> np.ndarray:
        """An array (base, exponent) with exponents 0 to n at least."""
        while self.table.shape[1] <= n:
            k = self.table.shape[1]
            top = np.array([[pow(b, k, PRIME)] for b in self.bases], np.uint64)
            self.table = np.concatenate([self.table, _fold(self.table * top)], axis=1)
        return self.table


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


class PrefixHashes:
    """The prefix array of a whole text: ``sums[b, i]`` is the sum of character * base^position before i."""

    def __init__(self, text: str, powers: Powers) -> None:
        self.powers, codes = powers, code_points(text)
        self.n = len(codes)
        terms = _fold(codes * powers.up_to(self.n)[:, : self.n])
        self.sums = np.zeros((len(BASES), self.n + 1), np.uint64)
        self.sums[:, 1:] = _fold(np.cumsum(terms, axis=1))

    def _span(self, i: int, length: int, shift: int) -> tuple[int, ...]:
        return tuple(
            (int(s[i + length]) - int(s[i])) % PRIME * int(p[shift]) % PRIME
            for s, p in zip(self.sums, self.powers.table, strict=True)
        )

    def same(self, i: int, other: PrefixHashes, j: int, length: int) -> bool:
        """Whether the spans of ``length`` at i here and at j there are equal."""
        self.powers.up_to(max(i, j))
        return self._span(i, length, j) == other._span(j, length, i)

    def common_extension(self, i: int, other: PrefixHashes, j: int) -> int:
        """How many characters from i here and from j there agree, by binary search."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.same(i, other, j, mid) else (low, mid - 1)
        return low


def _stride(n: int, samples: int) -> int:
    s = 1
    while n > s * samples:
        s *= 2
    return s


def fingerprint(text: str, powers: Powers, samples: int = SAMPLES) -> str:
    """``<length>:<hash of the whole>:<prefix samples>:<suffix samples>:<stride>:<pieces>`` in hexadecimal, 16 digits a
    sample, 18 a piece.

    Prefix samples hash the first k strides, suffix samples the last k strides, k = 1, 2, ...; suffix hashes
    count positions from the end, so that both depend on nothing but the characters they cover.
    """
    codes = code_points(text)
    n, stride = len(codes), _stride(len(codes), samples)
    pows = powers.up_to(n)[:, :n]

    def sampled(terms: np.ndarray) -> np.ndarray:
        if not n:
            return np.zeros(0, np.uint64)
        blocks = np.add.reduceat(terms, np.arange(0, n, stride), axis=1)
        sums = _fold(np.cumsum(_fold(blocks), axis=1))
        return (sums[0] << np.uint64(32)) | sums[1]

    terms = _below(codes * pows)
    front, back = sampled(terms), sampled(_below(codes[::-1] * pows))
    whole = int(front[-1]) if n else 0
    full = n // stride
    hexed = lambda a: a.astype(">u8").tobytes().hex()
    return f"{n:x}:{whole:016x}:{hexed(front[:full])}:{hexed(back[:full])}:{_pieces(terms[0], powers)}"


def _pieces(terms: np.ndarray, powers: Powers) -> str:
    """``<stride>:<pieces>`` of a text's terms character * base^position: from each picked place to the next, a piece's hash (8 digits), length (8) and the power
    of two by which the hash that closes it is divisible beyond the stride (2), in hexadecimal."""
    n, stride = len(terms), _stride(len(terms), PIECES)
    if not n:
        return "1:"
    back = powers.inverse.up_to(n)[0]
    sums = np.zeros(n + 1, np.uint64)
    sums[1:] = _fold(np.cumsum(terms))
    width = min(PICK, n)
    seen = _fold(_below((sums[width:] + np.uint64(PRIME) - sums[:-width]) * back[: n + 1 - width]))
    # Multiplied once more, as low digits of a polynomial hash follow the characters.
    seen = seen * np.uint64(2654435761) >> np.uint64(20) & np.uint64(0xFFFFFFFF)
    ends = np.flatnonzero(seen & np.uint64(stride - 1) == 0) + width
    level = seen[ends - width] >> np.uint64(stride.bit_length() - 1) | np.uint64(1 << 31)
    level = np.log2((level & (~level + np.uint64(1))).astype(float)).astype(np.int64)
    if not len(ends) or ends[-1] != n:
        ends, level = np.append(ends, n), np.append(level, 31)  # the text's end closes a piece at every stride
    level[-1] = 31
    starts = np.append(0, ends[:-1])
    spans = _fold(_fold(sums[ends] + np.uint64(PRIME) - sums[starts]) * back[starts])
    record = np.empty(len(ends), np.dtype([("hash", ">u4"), ("length", ">u4"), ("level", "u1")]))
    record["hash"], record["length"], record["level"] = spans, ends - starts, level
    return f"{stride:x}:{record.tobytes().hex()}"


def _read_pieces(stride: str, text: str) -> tuple[int, list[tuple[int, int, int]]]:
    record = np.frombuffer(bytes.fromhex(text), np.dtype([("hash", ">u4"), ("length", ">u4"), ("level", "u1")]))
    return int(stride, 16), list(zip(*(record[c].tolist() for c in ("hash", "length", "level")), strict=True))


@lru_cache(maxsize=1 << 16)
def _power(length: int) -> int:
    return pow(BASES[0], length, PRIME)


def _coarser(pieces: list[tuple[int, int, int]], steps: int) -> list[tuple[int, int]]:
    """Pieces as they would be at a stride ``steps`` doublings larger: hashes of neighbours make that of both."""
    if not steps:
        return [piece[:2] for piece in pieces]
    out, whole, length = [], 0, 0
    for h, n, level in pieces:
        whole, length = (whole + h * _power(length)) % PRIME if length else h, length + n
        if level >= steps:
            out.append((whole, length))
            whole, length = 0, 0
    return out


def _in_common(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> int:
    """Characters of the longest chain of equal pieces that rises in both, what the two begin and end with first: of
    a repeated piece, places are tried from the last to the first."""
    start = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    ahead = sum(n for _, n in a[:start])
    a, b = a[start:], b[start:]
    stop = next((k for k, (x, y) in enumerate(zip(reversed(a), reversed(b), strict=False)) if x != y), min(len(a), len(b)))
    behind = sum(n for _, n in a[len(a) - stop :])
    a, b = a[: len(a) - stop], b[: len(b) - stop]
    both = set(a).intersection(b)
    if not both:
        return ahead + behind
    places: dict[tuple[int, int], list[int]] = {}
    for j, piece in enumerate(b):
        if piece in both:
            places.setdefault(piece, []).append(j)
    ends: list[int] = []
    links: list[tuple[int, int]] = []
    tails: list[int] = []
    for piece in a:
        if piece not in both:
            continue
        for j in reversed(places[piece]):
            k = bisect_left(ends, j)
            links.append((piece[1], tails[k - 1] if k else -1))
            ends[k : k + 1], tails[k : k + 1] = [j], [len(links) - 1]
    total, k = ahead + behind, tails[-1] if tails else -1
    while k >= 0:
        n, k = links[k]
        total += n
    return total


@lru_cache(maxsize=4)
def _parsed(fp: str) -> tuple[int, list[np.ndarray], int, list[tuple[int, int, int]]]:
    """Length, prefix and suffix samples, stride and pieces; neighbours are compared one after the other, so the
    last few are kept."""
    n, _, front, back, stride, pieces = fp.split(":")
    samples = [np.frombuffer(bytes.fromhex(x), ">u8").astype(np.uint64) for x in (front, back)]
    return int(n, 16), samples, *_read_pieces(stride, pieces)


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """Samples up to which two prefix (or suffix) arrays agree: equal prefixes have equal shorter prefixes, so
    a binary search finds the last equal one."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[mid - 1] == b[mid - 1] else (low, mid - 1)
    return low


def _spans(samples: np.ndarray) -> np.ndarray:
    """Hashes of the spans between successive samples, by base."""
    both = np.stack([samples >> np.uint64(32), samples & np.uint64(0xFFFFFFFF)]).astype(np.int64)
    return np.diff(both, axis=1, prepend=0) % PRIME


def likeness(fp: str, other: str, samples: int = SAMPLES) -> float:
    """Part of the longer text that agrees, 0 to 1: from the front and from the back, in equal blocks at equal
    distance from either end, or in equal pieces in the same order, whichever is most. Equal fingerprints give 1."""
    if fp == other:
        return 1.0
    (n, mine, cut, pieces), (m, theirs, cut_other, others) = _parsed(fp), _parsed(other)
    if not n or not m:
        return 0.0
    stride = max(_stride(n, samples), _stride(m, samples))
    agree = []
    for a, b in zip(mine, theirs, strict=True):
        step_a, step_b = stride // _stride(n, samples), stride // _stride(m, samples)
        a, b = a[step_a - 1 :: step_a], b[step_b - 1 :: step_b]
        k = min(len(a), len(b))
        agree.append((_agreeing(a, b), int((_spans(a[:k]) == _spans(b[:k])).all(axis=0).sum())))
    (front, front_blocks), (back, back_blocks) = agree
    shared = max(cut, cut_other)
    pieces, others = (_coarser(p, (shared // own).bit_length() - 1) for p, own in ((pieces, cut), (others, cut_other)))
    most = max(max(front + back, front_blocks, back_blocks) * stride, _in_common(pieces, others))
    return min(most, n, m) / max(n, m)


def _windows(text: PrefixHashes, positions: np.ndarray, w: int, top: int) -> np.ndarray:
    """Hashes (first base) of the spans of w at the positions, all shifted to position ``top``."""
    s = text.sums[0]
    return _fold((s[positions + w] + np.uint64(PRIME) - s[positions]) % np.uint64(PRIME) * text.powers.up_to(top)[0, top - positions])


def _anchors(a: PrefixHashes, b: PrefixHashes, gap: tuple[int, int, int, int], w: int) -> list[tuple[int, int]]:
    """The longest chain, rising in both texts, of equal spans of w: every w-th one of b's against all of a's."""
    i0, i1, j0, j1 = gap
    top = max(a.n, b.n)
    js, at = np.arange(j0, j1 - w + 1, w), np.arange(i0, i1 - w + 1)
    theirs, mine = _windows(b, js, w, top), _windows(a, at, w, top)
    seen = np.zeros(1 << 16, bool)
    seen[theirs & np.uint64(0xFFFF)] = True
    hit = np.flatnonzero(seen[mine & np.uint64(0xFFFF)])
    hit = hit[np.isin(mine[hit], theirs)]
    # Hash and position in one number of 31 + 32 bits, so that a span's equals lie in order of position.
    found = np.sort((mine[hit] << np.uint64(32)) | at[hit].astype(np.uint64))
    own = (theirs << np.uint64(32)) | (js - j0 + i0).astype(np.uint64)
    near = np.searchsorted(found, own)
    ends: list[int] = []
    links: list[tuple[int, int, int]] = []
    tails: list[int] = []
    for j, h, k in zip(js.tolist(), theirs.tolist(), near.tolist(), strict=True):
        places = [int(x) & 0xFFFFFFFF for x in found[max(k - PLACES, 0) : k + PLACES] if int(x) >> 32 == h]
        for i in reversed(places):
            n = bisect_left(ends, i)
            links.append((i, j, tails[n - 1] if n else -1))
            ends[n : n + 1], tails[n : n + 1] = [i], [len(links) - 1]
    chain, k = [], tails[-1] if tails else -1
    while k >= 0:
        i, j, k = links[k]
        chain.append((i, j))
    return chain[::-1]


def _common_before(a: PrefixHashes, i: int, b: PrefixHashes, j: int, most: int) -> int:
    """How many characters before i and before j agree, up to ``most``, by binary search."""
    low, high = 0, most
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a.same(i - mid, b, j - mid, mid) else (low, mid - 1)
    return low


def matched(a: PrefixHashes, b: PrefixHashes) -> int:
    """Characters that agree in an alignment of two texts: the common start and end, then from anchors of each of
    ``WINDOWS`` as far as both sides agree, and so on in the gaps that are left."""
    total, gaps = 0, [(0, a.n, 0, b.n, 0)]
    while gaps:
        i0, i1, j0, j1, level = gaps.pop()
        k = min(a.common_extension(i0, b, j0), i1 - i0, j1 - j0)
        i0, j0, total = i0 + k, j0 + k, total + k
        k = _common_before(a, i1, b, j1, min(i1 - i0, j1 - j0))
        i1, j1, total = i1 - k, j1 - k, total + k
        while level < len(WINDOWS) and min(i1 - i0, j1 - j0) < WINDOWS[level]:
            level += 1
        if level == len(WINDOWS) or level == len(WINDOWS) - 1 and max(i1 - i0, j1 - j0) > SHORT_GAP:
            continue
        for i, j in _anchors(a, b, (i0, i1, j0, j1), WINDOWS[level]):
            if i < i0 or j < j0 or not a.same(i, b, j, WINDOWS[level]):
                continue
            back = _common_before(a, i, b, j, min(i - i0, j - j0))
            on = min(a.common_extension(i, b, j), i1 - i, j1 - j)
            gaps.append((i0, i - back, j0, j - back, level + 1))
            i0, j0, total = i + on, j + on, total + back + on
        gaps.append((i0, i1, j0, j1, level + 1))
    return total


def aligned_likeness(a: PrefixHashes, b: PrefixHashes) -> float:
    """Part of the longer text that agrees with the other at any offset, 0 to 1; two empty texts give 1."""
    return matched(a, b) / max(a.n, b.n) if a.n or b.n else 1.0


def edited(text: str, following: str) -> str:
    """``text`` whose last third is replaced by as many characters from the head of ``following``."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k] if k else text


def _block_heads(docs: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[int]:
    """Ids at which blocks of consecutive ids (descending) begin, each of about ``block_bytes`` of text.

    One number per block reaches the driver, as with the bounds of a range partitioning.
    """
    sizes = docs.select(F.col(id_col).cast("long").alias("id"), (F.coalesce(F.octet_length(text_col), F.lit(0)) + 16).cast("long").alias("b"))
    sizes = sizes.groupBy("id").agg(F.sum("b").alias("b"))

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        room = 0
        for pdf in batches:
            found = []
            for i, b in zip(pdf["id"], pdf["b"], strict=True):
                if room <= 0:
                    found.append(i)
                    room = block_bytes
                room -= b
            yield pd.DataFrame({"id": pd.Series(found, dtype="int64")})

    ordered = sizes.repartitionByRange(target_partitions(sizes), F.col("id").desc()).sortWithinPartitions(F.col("id").desc())
    return sorted(r["id"] for r in ordered.mapInPandas(heads, "id long").collect())


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def neighbour_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           samples: int = SAMPLES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The next document is the one with the next smaller id; the smallest id is followed by the largest (a single
    document follows itself). Rows that share an id are ordered by text; a null text counts as empty, a null id
    as the smallest id, -2^63. An empty text has the fingerprint of no characters; its likeness to another is
    0, to an empty one 1. Other columns are ignored; an empty table gives an empty result. ``near_edited`` and
    ``near_next`` are the ``likeness`` of the fingerprints, and nothing else.
    """
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    heads = np.array(_block_heads(rows, "id", "text", block_bytes), np.int64)

    @F.pandas_udf("array<int>")
    def blocks(ids: pd.Series) -> pd.Series:
        # Block k holds the ids from heads[k] down to above heads[k - 1]; its head also closes block k + 1.
        at = np.searchsorted(heads, ids.to_numpy(), side="left")
        head = heads[np.minimum(at, len(heads) - 1)] == ids.to_numpy()
        return pd.Series([[k, (k + 1) % len(heads) + len(heads)] if h else [k] for k, h in zip(at.tolist(), head.tolist(), strict=True)])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        powers = Powers()
        pdf = pdf.sort_values(["tail", "neg", "text"], kind="stable")
        own = int((~pdf["tail"]).sum())
        ids, texts = pdf["id"].tolist(), pdf["text"].tolist()
        out, mine = [], fingerprint(texts[0], powers, samples) if own else ""
        for i in range(own):
            new = edited(texts[i], texts[i + 1])
            following = fingerprint(texts[i + 1], powers, samples)
            changed = fingerprint(new, powers, samples)
            near = likeness(mine, changed, samples), likeness(mine, following, samples)
            out.append((ids[i], len(texts[i]), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), mine, changed, *near))
            mine = following
        return pd.DataFrame(out, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    n = len(heads)
    dealt = rows.withColumn("k", F.explode(blocks("id"))).select(
        "id", "text", (F.col("k") % max(n, 1)).alias("block"), (F.col("k") >= n).alias("tail"), F.bitwise_not(F.col("id")).alias("neg"))
    return dealt.groupBy("block").applyInPandas(walk, RESULT)


__all__ = ["PrefixHashes", "Powers", "aligned_likeness", "edited", "fingerprint", "likeness", "matched", "neighbour_fingerprints"]
