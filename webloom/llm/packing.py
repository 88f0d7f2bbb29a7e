"""Packing documents into fixed windows by the sum-of-squares rule, online.

A document fills whole windows of its own first; what is left of it goes into the open window whose fill level
makes the sum of squared counts of open windows per level smallest. The counts are kept in a level array, so
placing a document is one pass over the levels. A window that ends at a power of two needs no padding, so
those levels weigh nothing in the sum. Windows still open when a task's documents are placed are laid out
anew, cut wherever a window is full; each task leaves at most one window that needs padding.

Every task packs its own partition of the input; only counts of windows per task are summed up to number them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import materialize, partition_offsets, release_memory
from webloom.llm.token_pieces import encoder

WINDOW = 1024
PIECES = ("part int, row_id long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "window long, offset long")


class SumOfSquares:
    """Open windows by fill level, and the rule that picks the next level."""

    def __init__(self, window: int) -> None:
        self.window = window
        level = np.arange(window + 1)
        #: 1 for levels that would be padded: all but 0, the full window and powers of two.
        self.weight = ((level > 0) & (level < window) & ((level & (level - 1)) != 0)).astype(np.int64)
        self.counts = np.zeros(window + 1, np.int64)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def place(self, size: int, fresh: int) -> tuple[int, int]:
        """Window and fill level to put ``size`` tokens at; ``fresh`` is the number of a new window."""
        last = self.window - size
        change = self.weight[size:] * (2 * self.counts[size:] + 1)  # the level that a window reaches
        change -= self.weight[: last + 1] * (2 * self.counts[: last + 1] - 1)  # and the one that it leaves
        change[1:][self.counts[1 : last + 1] == 0] = np.iinfo(np.int64).max
        level = last - int(np.argmin(change[::-1]))  # of equals, the fullest
        chosen = fresh
        if level:
            self.counts[level] -= 1
            chosen = self.open[level].pop()
        if level + size < self.window:
            self.counts[level + size] += 1
            self.open[level + size].append(chosen)
        return chosen, level


def pack_partition(docs: Iterator[tuple[int, int | None, np.ndarray]], window: int) -> Iterator[tuple]:
    """Pieces ``(row_id, doc_id, start, length, crc32, doc_tokens, window, offset)`` of ``(row_id, doc_id, ids)``.

    Windows are numbered from 0 as they are closed.
    """
    levels, opened, closed = SumOfSquares(window), 0, 0
    held: dict[int, list[tuple]] = {}  # the documents' rests in open windows

    def pieces(rests: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for row, doc, start, ids, total in rests:
            yield row, doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, closed, offset
            offset += len(ids)

    for row, doc, ids in docs:
        n = len(ids)
        whole = n - n % window
        for start in range(0, whole, window):
            yield from pieces([(row, doc, start, ids[start : start + window], n)])
            closed += 1
        if n > whole:
            number, level = levels.place(n - whole, opened)
            opened += number == opened
            held.setdefault(number, []).append((row, doc, whole, ids[whole:], n))
            if level + n - whole == window:
                yield from pieces(held.pop(number))
                closed += 1
    # Windows left open: those at a power of two stay, the others are laid out one after the other.
    laid: list[tuple] = []
    room = window
    for rests in [held[k] for k in sorted(held)]:
        if not levels.weight[sum(len(x[3]) for x in rests)]:
            yield from pieces(rests)
            closed += 1
            continue
        for row, doc, start, ids, total in rests:
            while len(ids):
                part, ids = ids[:room], ids[room:]
                laid.append((row, doc, start, part, total))
                start, room = start + len(part), room - len(part)
                if not room:
                    yield from pieces(laid)
                    closed, laid, room = closed + 1, [], window
    if laid:
        yield from pieces(laid)


def pack(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
         window: int = WINDOW) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, row_id``.

    A document is the ids of its whole text and the end id; every id is in exactly one piece. ``row_id`` tells
    rows that repeat an id apart (each is packed). Null text counts as empty: a piece of the end id alone. Very
    long documents fill windows of their own first. Other columns are ignored; an empty table gives no piece.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)

        def rows() -> Iterator[tuple[int, int | None, np.ndarray]]:
            row = part << 33
            for pdf in batches:
                for doc, ids in zip(pdf["doc_id"].tolist(), own.encode_many(pdf["text"].tolist()), strict=True):
                    yield row, None if doc != doc or doc is None else int(doc), np.append(ids, end)
                    row += 1

        def frame(found: list[tuple]) -> pd.DataFrame:
            out = pd.DataFrame(found, columns=["row_id", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "window", "offset"])
            return out.astype({"doc_id": "Int64"}).assign(part=part)

        found: list[tuple] = []
        for x in pack_partition(rows(), window):
            found.append(x)
            if len(found) == 10_000:
                yield frame(found)
                found = []
        if found:
            yield frame(found)
        release_memory()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = materialize(rows.mapInPandas(run, PIECES))
    before = partition_offsets(pieces.groupBy("part").agg((F.max("window") + 1).alias("windows")), "part", ["windows"])
    return pieces.join(F.broadcast(before), "part").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("windows_before") + F.col("window")).alias("sequence_id"), "offset", "row_id")
