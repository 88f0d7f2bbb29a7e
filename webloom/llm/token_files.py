"""Token ids in files: frequency-ranked, in a byte-aligned variable-length code with separate control bytes.

Ids are replaced by their rank by frequency over the whole corpus, so that frequent ids take one byte. Four
ranks share a control byte, two bits each for their lengths of one to four bytes; control bytes and data bytes
are separate streams, decoded with numpy by looking up the four lengths of each control byte.

A file set is two Parquet folders in shared storage: ``ranks`` (the id of each rank) and ``blocks``, in ascending
document order over the files (``part`` numbers them). A block holds whole documents: their ids, token counts,
the control stream and the data stream, and the number of tokens before it in its file. Spark's writers commit
whole files, so a lost executor leaves none half-written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.llm.common import discard, materialize, partition_offsets, release_memory
from webloom.llm.token_pieces import encoder, forget_encoders
from webloom.session import target_partitions

#: Ids after which a block is closed (a longer document has a block of its own).
BLOCK_IDS = 1 << 16
#: Bytes of ids in a part of the files: a task sorts that much, and a part's blocks may reach a task all at once.
PART_BYTES = 32 << 20
#: Lengths of the four values of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1

BLOCKS = "part int, before long, n_ids long, doc_ids array<long>, counts array<int>, control binary, data binary"


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of unsigned 32-bit values."""
    extra = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    fours = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    fours[: len(ranks)] = extra
    control = (fours.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    width = 2 if ranks.max(initial=0) < 1 << 16 else 4  # bytes looked at
    data = ranks.astype(f"<u{width}").view(np.uint8).reshape(-1, width)[np.arange(width) <= extra[:, None]]
    return control.tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    width = 2 if lengths.max(initial=0) <= 2 else 4
    out = np.zeros((n, width), np.uint8)
    out[np.arange(width) < lengths[:, None]] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view(f"<u{width}").astype("<u4", copy=False)


def tokens(docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, width, ids)``: the ids of each whole text and the end id, unsigned little-endian, ``width`` bytes
    each: 2 or 4, the same for all documents, as the vocabulary needs."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(tokenizer)
        end = np.array([end_id], np.uint32)
        width = 2 if max(own.largest_id, end_id) < 1 << 16 else 4
        for pdf in batches:
            coded = own.encode_many(pdf["text"].tolist())
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "width": width, "ids": [np.append(c, end).astype(f"<u{width}").tobytes() for c in coded]})
        release_memory()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInPandas(encode, "doc_id long, width int, ids binary")


def ids_by_rank(coded: DataFrame) -> DataFrame:
    """``(rank, id, n)``: every id that occurs, by falling count over all documents, ties by id."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget_encoders()
        total = np.zeros(0, np.int64)
        for pdf in batches:
            got = np.bincount(np.frombuffer(b"".join(pdf["ids"]), f"<u{pdf['width'].iloc[0]}"))
            size = max(len(got), len(total))
            total = np.pad(total, (0, size - len(total))) + np.pad(got, (0, size - len(got)))
        found = np.flatnonzero(total)
        yield pd.DataFrame({"id": found, "n": total[found]})

    counted = coded.select("width", "ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    # At most one row per entry of the tokenizer's vocabulary.
    rows = sorted(((r["n"], r["id"]) for r in counted.collect()), key=lambda x: (-x[0], x[1]))
    return coded.sparkSession.createDataFrame([(k, i, n) for k, (n, i) in enumerate(rows)], "rank long, id long, n long")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Write the file set of ``docs`` under ``path`` in ascending id order.

    Null text counts as empty (just the end id). A null id sorts first; rows that repeat an id are all written,
    ordered by their ids' bytes. Very long documents get a block of their own; an empty table gives empty
    folders with the schema. Other columns are ignored.
    """
    spark = docs.sparkSession
    coded = materialize(tokens(docs, tokenizer, end_id, id_col, text_col))
    by_rank = ids_by_rank(coded)
    by_rank.write.mode("overwrite").parquet(f"{path}/ranks")
    table = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.int64)
    rank_of = np.zeros(int(table.max(initial=0)) + 1, np.uint32)
    rank_of[table] = np.arange(len(table), dtype=np.uint32)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, before = TaskContext.get().partitionId(), 0
        docs_held: list = []
        held: list[bytes] = []
        size, width = 0, 4

        def block() -> pd.DataFrame:
            control, data = encode_ranks(rank_of[np.frombuffer(b"".join(held), f"<u{width}")])
            return pd.DataFrame([(part, before, size, docs_held, [len(h) // width for h in held], control, data)],
                                columns=["part", "before", "n_ids", "doc_ids", "counts", "control", "data"])

        for pdf in batches:
            width = int(pdf["width"].iloc[0])
            for doc_id, ids in zip(pdf["doc_id"].tolist(), pdf["ids"], strict=True):
                docs_held.append(None if doc_id != doc_id or doc_id is None else int(doc_id))
                held.append(ids)
                size += len(ids) // width
                if size >= block_ids:
                    yield block()
                    before, docs_held, held, size = before + size, [], [], 0
        if held:
            yield block()
        release_memory()

    ordered = coded.repartitionByRange(target_partitions(coded, PART_BYTES), "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInPandas(pack, BLOCKS).write.mode("overwrite").parquet(f"{path}/blocks")
    discard(coded)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from a file set: ``start`` counts the ids of all documents before, in
    file order; ``ids`` are unsigned 32-bit little-endian bytes."""
    table = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples(index=False):
                ids = table[decode_ranks(row.control, row.data, row.n_ids)].astype("<u4")
                counts = np.asarray(row.counts, np.int64)
                ends = np.cumsum(counts)
                yield pd.DataFrame({
                    "doc_id": pd.Series(list(row.doc_ids), dtype="Int64"), "start": row.before + row.part_before + ends - counts,
                    "n_tokens": counts, "ids": [ids[a:b].tobytes() for a, b in zip(ends - counts, ends, strict=True)]})

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    before = partition_offsets(blocks.groupBy("part").agg(F.sum("n_ids").alias("ids")), "part", ["ids"])
    placed = blocks.join(F.broadcast(before), "part").withColumnRenamed("ids_before", "part_before")
    return placed.mapInPandas(unpack, "doc_id long, start long, n_tokens long, ids binary")
