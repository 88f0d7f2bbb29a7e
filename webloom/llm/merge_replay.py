"""Byte-level BPE by replaying the merges over the words of the whole corpus.

1. Every text is cut into words (the matches of the pattern that goes with the rank file). Documents are held in
   chunks of bounded size; a chunk keeps its distinct words once, dealt by a hash of the word into compressed
   lists, and the documents as numbers of words.
2. The lists of all chunks meet by that hash, so that each distinct word of the corpus is coded in one place.
   There an inverted index leads from each mergeable pair of neighbouring tokens to the positions where it stands,
   and the merges are replayed in the order of their ranks: a merge visits its own positions alone and renews the
   pairs of the two neighbours it touches.
3. The ids go back to their chunks, where documents are put together from the ids of their words.

A word travels once per chunk that holds it, never once per occurrence.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import sys
import types
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import release_memory
from webloom.llm.token_files import decode_ranks, encode_ranks
from webloom.session import target_partitions

#: Characters of text after which a chunk is closed (a longer text is a chunk of its own).
CHUNK_CHARS = 1 << 23
#: Bytes of new words coded together, words of lists held for it, and coded words remembered in a task.
TOGETHER_BYTES, TOGETHER_WORDS, REMEMBERED = 1 << 19, 1 << 18, 200_000
#: Lists of words in a chunk at most; beyond it more of the corpus's words share a task.
HOMES = 2048

CHUNKS = ("chunk long, home int, doc_ids array<long>, counts array<int>, control binary, data binary, homes binary, "
          "words binary")
DOCUMENTS = -1  # the home of a chunk's documents; lists of words have homes from 0


class Ranks:
    """Token bytes by rank, and the rank that each pair of tokens merges into."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.rank = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.bytes_of: list[bytes] = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.bytes_of[rank] = token
        self.shift = len(self.bytes_of).bit_length()
        self.single = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.merged = {
            (self.rank[token[:k]] << self.shift) + self.rank[token[k:]]: rank
            for token, rank in self.rank.items() for k in range(1, len(token))
            if token[:k] in self.rank and token[k:] in self.rank
        }
        self.pairs = np.array(sorted(self.merged), np.int64)
        self.pair_ranks = np.array([self.merged[p] for p in self.pairs.tolist()], np.int64)


def ranks_of(path: str) -> Ranks:
    """This worker process's copy of a rank file."""
    held = sys.modules.setdefault("_webloom_ranks", types.ModuleType("_webloom_ranks"))
    if path not in held.__dict__:
        held.__dict__[path] = Ranks(path)
    return held.__dict__[path]


def replay(words: Sequence[bytes], ranks: Ranks) -> list[np.ndarray]:
    """The ids of each (non-empty) word.

    Every rank takes its positions from left to right. A merge may make a pair of a lower rank than its own (rank
    files need not be closed under merging); then the word's other positions wait until the lower rank is done. So
    each word sees the merges in exactly the order in which it would alone: lowest rank first, then leftmost.
    """
    known = [ranks.rank.get(w, -1) for w in words]  # a word that is a token itself is that token
    rest = [w for w, k in zip(words, known, strict=True) if k < 0]
    if not rest:
        return [np.array([k], np.uint32) for k in known]
    flat = ranks.single[np.frombuffer(b"".join(rest), np.uint8)]
    ends = np.cumsum([len(w) for w in rest])
    n = len(flat)
    codes = (flat[:-1] << ranks.shift) + flat[1:]
    at = np.minimum(np.searchsorted(ranks.pairs, codes), len(ranks.pairs) - 1) if len(ranks.pairs) else np.zeros(n - 1, np.int64)
    first = np.full(n, -1, np.int64)
    if len(ranks.pairs):
        first[:-1] = np.where(ranks.pairs[at] == codes, ranks.pair_ranks[at], -1)
    first[ends - 1] = -1  # no pair across words
    order = np.argsort(first, kind="stable")
    order = order[np.searchsorted(first[order], 0) :]
    cuts = np.flatnonzero(np.diff(first[order])) + 1
    index: dict[int, list[int]] = {int(first[g[0]]): g.tolist() for g in np.split(order, cuts) if len(g)}
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends - 1], before[ends[:-1]], before[0] = -1, -1, -1
    token, pair, nxt, prv, shift, merged_with = flat.tolist(), first.tolist(), after.tolist(), before.tolist(), ranks.shift, ranks.merged.get
    heap = sorted(index)
    while heap:
        rank = heapq.heappop(heap)
        waiting: set[int] = set()
        for p in sorted(index.pop(rank)):
            if pair[p] != rank:
                continue  # another merge took this token meanwhile
            if waiting and int(np.searchsorted(ends, p, "right")) in waiting:
                _note(index, heap, rank, p)
                continue
            q = nxt[p]
            e, b = nxt[q], prv[p]
            token[p], token[q], pair[q], nxt[p] = rank, -1, -1, e
            new = older = -1
            if e >= 0:
                prv[e] = p
                new = merged_with((rank << shift) + token[e], -1)
                if new >= 0:
                    _note(index, heap, new, p)
            pair[p] = new
            if b >= 0:
                pair[b] = older = merged_with((token[b] << shift) + rank, -1)
                if older >= 0:
                    _note(index, heap, older, b)
            if 0 <= new < rank or 0 <= older < rank:
                waiting.add(int(np.searchsorted(ends, p, "right")))
    left = np.array(token, np.int64)
    kept = left >= 0
    counts = np.add.reduceat(kept.astype(np.int64), np.append(0, ends[:-1]))
    parts = iter(np.split(left[kept].astype(np.uint32), np.cumsum(counts)[:-1]))
    return [np.array([k], np.uint32) if k >= 0 else next(parts) for k in known]


def _note(index: dict[int, list[int]], heap: list[int], rank: int, position: int) -> None:
    held = index.get(rank)
    if held is None:
        index[rank] = [position]
        heapq.heappush(heap, rank)
    else:
        held.append(position)


class Splitter:
    """Words of a text by a pattern, with the character classes of the tiktoken library.

    Unicode versions differ over characters that were assigned lately. Where the two libraries could differ, the
    character's class is asked of tiktoken itself, and a stand-in of that class takes its place while the text is
    cut.
    """

    def __init__(self, pattern: str) -> None:
        self.pattern, self.find = pattern, regex.compile(pattern).findall
        #: Above this character the libraries' Unicode tables are of different years.
        self.unsure = regex.compile(r"[^\x00-ԯ]")
        self.known: dict[str, str] = {}

    def _stand_in(self, char: str) -> str:
        if char not in self.known:
            import tiktoken

            table = {bytes([b]): b for b in range(256)}
            for probe in ("a", "1", "!", " "):
                table.setdefault((probe + char).encode(), len(table))
            library = tiktoken.Encoding("probe", pat_str=self.pattern, mergeable_ranks=table, special_tokens={})
            self.known[char] = next((p for p in ("a", "1", "!") if len(library.encode_ordinary(p + char)) == 1), char)
        return self.known[char]

    def words(self, text: str) -> list[str]:
        changed = text
        if not text.isascii():
            odd = {c: s for c in set(self.unsure.findall(text)) if (s := self._stand_in(c)) != c and not _same(c, s)}
            if odd:
                changed = text.translate({ord(c): s for c, s in odd.items()})
        found = self.find(changed)
        if changed is text:
            return found
        ends = np.cumsum([len(w) for w in found]).tolist()
        return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _same(char: str, stand_in: str) -> bool:
    """Whether the regex library has ``char`` in the class of ``stand_in`` already."""
    kind = {"a": r"\p{L}", "1": r"\p{N}", "!": r"[^\s\p{L}\p{N}]"}[stand_in]
    return regex.fullmatch(kind, char) is not None


def splitter(pattern: str) -> Splitter:
    held = sys.modules.setdefault("_webloom_splitters", types.ModuleType("_webloom_splitters"))
    if pattern not in held.__dict__:
        held.__dict__[pattern] = Splitter(pattern)
    return held.__dict__[pattern]


class _Numbers(dict):
    """Numbers of words, in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _listed(parts: Sequence[bytes]) -> bytes:
    lengths = np.fromiter(map(len, parts), "<u4", len(parts))
    return zstandard.compress(len(parts).to_bytes(4, "little") + lengths.tobytes() + b"".join(parts))


def _unlisted(blob: bytes) -> tuple[np.ndarray, bytes]:
    flat = zstandard.decompress(blob)
    n = int.from_bytes(flat[:4], "little")
    return np.frombuffer(flat, "<u4", n, 4).astype(np.int64), flat[4 + 4 * n :]


def chunks(docs: DataFrame, pattern: str, homes: int, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """``CHUNKS`` of ``(doc_id, text)``. Per chunk one row of documents, as numbers of their words (in the order in
    which the chunk first meets them, coded with control bytes), with the home of every word; and per home a
    row with the list of its words, in the same order."""
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.binary()] * 4]
    names = ["chunk", "home", "doc_ids", "counts", "control", "data", "homes", "words"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = splitter(pattern).words
        number = TaskContext.get().partitionId() << 33
        numbers = _Numbers()
        doc_ids: list = []
        found: list[np.ndarray] = []
        room = chunk_chars

        def chunk() -> Iterator[pa.RecordBatch]:
            control, data = encode_ranks(np.concatenate(found))
            words = [w.encode() for w in numbers]
            home = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % homes
            order = np.argsort(home, kind="stable")
            own = [(number, DOCUMENTS, doc_ids, [len(f) for f in found], zstandard.compress(control), zstandard.compress(data),
                    zstandard.compress(home.astype("<u4").tobytes()), None)]
            for run in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
                if len(run):
                    own.append((number, int(home[run[0]]), None, None, None, None, None, _listed([words[k] for k in run.tolist()])))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*own, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for k in range(batch.num_rows):
                text = batch["text"][k].as_py()
                words = find(text)
                found.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                doc_ids.append(batch["doc_id"][k].as_py())
                room -= len(text)
                if room <= 0:
                    yield from chunk()
                    number, room = number + 1, chunk_chars
                    numbers, doc_ids, found = _Numbers(), [], []
        if doc_ids:
            yield from chunk()
        release_memory()

    return docs.mapInArrow(cut, CHUNKS)


def word_ids(lists: DataFrame, ranks_path: str) -> DataFrame:
    """``(chunk, home, ids)`` of lists of words ``(chunk, home, words)``: the ids of each list's words, as a list of
    unsigned 32-bit little-endian values. A task codes a word once, as long as it remembers it."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(ranks_path)
        known: dict[bytes, bytes] = {}
        new: dict[bytes, None] = {}
        held: list[tuple[int, int, list[bytes]]] = []
        size = rows = 0

        def coded() -> pa.RecordBatch:
            fresh = list(new)
            known.update(zip(fresh, (i.astype("<u4").tobytes() for i in replay(fresh, ranks)), strict=True))
            ids = [_listed([known[w] for w in words]) for _, _, words in held]
            return pa.record_batch([pa.array([h[0] for h in held], pa.int64()), pa.array([h[1] for h in held], pa.int32()),
                                    pa.array(ids, pa.binary())], names=["chunk", "home", "ids"])

        for batch in batches:
            for k in range(batch.num_rows):
                lengths, flat = _unlisted(batch["words"][k].as_py())
                ends = np.cumsum(lengths).tolist()
                words = [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]
                held.append((batch["chunk"][k].as_py(), batch["home"][k].as_py(), words))
                fresh = dict.fromkeys(w for w in words if w not in known and w not in new)
                new.update(fresh)
                size, rows = size + sum(map(len, fresh)), rows + len(words)
                if size >= TOGETHER_BYTES or rows >= TOGETHER_WORDS:
                    yield coded()
                    held, new, size, rows = [], {}, 0, 0
                    if len(known) > REMEMBERED:
                        known.clear()
        if held:
            yield coded()
        release_memory()

    return lists.mapInArrow(code, "chunk long, home int, ids binary")


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, ids)``, one row per row of ``docs``: the ids of the whole text as unsigned 32-bit
    little-endian bytes, as the tiktoken library gives them for this rank file without special tokens.

    Null text counts as empty and gives no ids. Rows that repeat an id, or have none, are all coded; equal texts get
    equal ids. A very long text is a chunk of its own, a very long word is replayed on its own. Other columns are
    ignored; an empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spread = target_partitions(rows, 16 << 20)
    # One exchange serves both sides below: no column or row is left out between it and Python, so Spark reuses it.
    held = chunks(rows, pattern, min(4 * spread, HOMES)).repartition(spread, "chunk")

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["chunk", "home", "words"]).filter(batch["words"].is_valid())

    listed = held.mapInArrow(lists, "chunk long, home int, words binary").repartition(spread, "home")
    coded = word_ids(listed, ranks_path)

    def put_together(chunk: pa.Table, lists: pa.Table) -> pa.Table:
        chunk = chunk.filter(chunk["homes"].is_valid())
        parts = [_unlisted(ids) for ids in lists.sort_by("home")["ids"].to_pylist()]
        homes = np.frombuffer(zstandard.decompress(chunk["homes"][0].as_py()), "<u4")
        order = np.argsort(homes, kind="stable")  # the words as the lists have them
        flat = np.frombuffer(b"".join(ids for _, ids in parts), "<u4")
        listed = np.concatenate([n for n, _ in parts]) // 4 if parts else np.zeros(0, np.int64)
        lengths, starts = np.zeros(len(homes), np.int64), np.zeros(len(homes), np.int64)
        lengths[order], starts[order] = listed, np.cumsum(listed) - listed
        doc_ids, counts = chunk["doc_ids"][0].as_py(), chunk["counts"][0].as_py()
        words = decode_ranks(*(zstandard.decompress(chunk[c][0].as_py()) for c in ("control", "data")), sum(counts))
        out, n_tokens, at = [], [], 0
        for n in counts:
            own = words[at : at + n]
            at += n
            sizes = lengths[own]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if n else 0
            out.append(flat[np.arange(total) + np.repeat(starts[own] - (ends - sizes), sizes)].tobytes() if n else b"")
            n_tokens.append(total)
        return pa.table({"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(n_tokens, pa.int64()),
                         "ids": pa.array(out, pa.binary())})

    # A chunk of empty texts has no lists; the cogroup still meets its documents.
    return held.groupBy("chunk").cogroup(coded.groupBy("chunk")).applyInArrow(put_together, "doc_id long, n_tokens long, ids binary")


def decode(coded: DataFrame, ranks_path: str) -> DataFrame:
    """``coded`` with ``bytes``: the bytes of each row's ``ids`` looked up in the rank file."""
    schema = coded.select("*", F.lit(b"").alias("bytes")).schema

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(ranks_path)
        for batch in batches:
            texts = [text_of(ids.as_py(), ranks) for ids in batch["ids"]]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "bytes"])
        release_memory()

    return coded.mapInArrow(look_up, schema)


def text_of(ids: bytes, ranks: Ranks) -> bytes:
    """The bytes of unsigned 32-bit little-endian ids."""
    return b"".join(map(ranks.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def digests(coded: DataFrame, ranks_path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of ``encode``'s rows: SHA-256 of the decimal ids joined by
    commas, and of the bytes that the ids decode to. Text by text, so that no batch is held decoded."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = ranks_of(ranks_path)
        decimal = [str(i) for i in range(len(ranks.bytes_of))].__getitem__
        for batch in batches:
            ids_sha, text_sha = [], []
            for ids in batch["ids"]:
                own = ids.as_py()
                ids_sha.append(hashlib.sha256(",".join(map(decimal, np.frombuffer(own, "<u4").tolist())).encode()).hexdigest())
                text_sha.append(hashlib.sha256(text_of(own, ranks)).hexdigest())
            yield pa.record_batch([batch["doc_id"], batch["n_tokens"], pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                                  names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
        release_memory()

    return coded.mapInArrow(hashed, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
