"""Merkle manifest of a table: one tree per source, and one over the sources' roots.

Nodes are hashed by threes: while several nodes remain, every three consecutive ones become one (the last run may
hold fewer, even one). A tree is cut into aligned subtrees ("blocks") of a fixed height; the roots of a tree's
blocks are the leaves of the next level of blocks, until one block holds them all. So no group exceeds one block,
whatever a source's share of the rows.

A block is one row, its node digests in one byte string in van Emde Boas order: the upper half of the levels first,
then the subtrees below it from left to right, each laid out by the same rule. ``places`` is the address arithmetic;
it serves building a block, reading a node's siblings, and nothing in it depends on how many nodes fit a page.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import materialize, release_memory
from webloom.operators.distribute import row_numbers
from webloom.session import target_partitions

FAN = 3
#: Levels above the leaves of a block (3 ** 6 = 729 leaves).
HEIGHT = 6
DIGEST = 32
#: The tree over the sources' roots is stored beside the sources' own trees.
TOP, OWN = 1, 0


@lru_cache(maxsize=64)
def places(height: int) -> tuple[np.ndarray, ...]:
    """For each depth (0 is the root) the places of its nodes, left to right, in the layout of a tree of ``height``."""
    if height == 0:
        return (np.zeros(1, np.int64),)
    upper = (height - 1) // 2  # height of the upper tree; each lower tree hangs below one of its leaves
    lower = height - upper - 1
    above, below = places(upper), places(lower)
    size = _nodes(lower)
    first = _nodes(upper) + size * np.arange(FAN ** (upper + 1))
    return (*above, *((first[:, None] + b[None, :]).reshape(-1) for b in below))


def _nodes(height: int) -> int:
    return int((FAN ** (height + 1) - 1) // (FAN - 1))


def height_of(n: int, limit: int) -> int:
    """Levels above ``n`` nodes until one remains, at most ``limit``."""
    height = 0
    while n > 1 and height < limit:
        n, height = -(-n // FAN), height + 1
    return height


def hashed(digests: Sequence[bytes]) -> bytes:
    """SHA-256 of digests as concatenated hex text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def build(leaves: Sequence[bytes], height: int) -> bytes:
    """The layout of a block: node digests at their places, zeros where there is no node."""
    out = bytearray(_nodes(height) * DIGEST)
    level = list(leaves)
    for depth in range(height, -1, -1):
        for place, digest in zip(places(height)[depth].tolist(), level, strict=False):
            out[place * DIGEST : (place + 1) * DIGEST] = digest
        level = [hashed(level[k : k + FAN]) for k in range(0, len(level), FAN)]
    return bytes(out)


def node(layout: bytes, height: int, depth: int, k: int) -> bytes:
    place = int(places(height)[depth][k])
    return layout[place * DIGEST : (place + 1) * DIGEST]


def siblings(layout: bytes, height: int, n: int, k: int) -> list[tuple[int, list[bytes]]]:
    """The runs that leaf ``k`` of ``n`` passes, from below: its place in the run and the run's other nodes."""
    out = []
    for depth in range(height, 0, -1):
        first = k - k % FAN
        run = range(first, min(first + FAN, n))
        out.append((k - first, [node(layout, height, depth, i) for i in run if i != k]))
        n, k = -(-n // FAN), k // FAN
    return out


def folded(leaf: bytes, path: Sequence[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for at, others in path:
        leaf = hashed([*others[:at], leaf, *others[at:]])
    return leaf


def packed(path: Sequence[tuple[int, list[bytes]]]) -> bytes:
    """A path as bytes: place and number of siblings, then the siblings, level by level."""
    return b"".join(bytes([at, len(others)]) + b"".join(others) for at, others in path)


def unpacked(path: bytes) -> list[tuple[int, list[bytes]]]:
    out, k = [], 0
    while k < len(path):
        at, n = path[k], path[k + 1]
        k += 2
        out.append((at, [path[k + i * DIGEST : k + (i + 1) * DIGEST] for i in range(n)]))
        k += n * DIGEST
    return out


def leaf_digest(*columns: Column) -> Column:
    """SHA-256 hex of columns, each ``-`` if null, else its UTF-8 byte count, ``:`` and its value."""
    def shown(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*[shown(c) for c in columns]).cast("binary"), 256)


@dataclass
class Manifest:
    """``leaves``: ``(source, block, slot, ...)``, a row per leaf with its place; ``levels``: per level of blocks,
    ``(source, block, n, height, layout, digest of the block's root)``; ``top``: the same of the tree over the
    sources, whose leaves are named in ``sources``. Everywhere ``source`` is ``=`` and the source, or empty for null."""

    leaves: DataFrame
    levels: list[DataFrame]
    sources: DataFrame
    top: list[DataFrame]


def _blocks(leaves: DataFrame, height: int) -> DataFrame:
    """One level of blocks of ``(source, block, slot, digest, total)``: ``total`` is the tree's count of nodes here."""
    def make(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("slot")
        own = height_of(int(rows["total"].iloc[0]), height)
        layout = build([bytes(d) for d in rows["digest"]], own)
        first = rows.iloc[0]
        return pd.DataFrame({"source": [first["source"]], "block": [first["block"]], "n": [len(rows)], "height": [own],
                             "layout": [layout], "digest": [node(layout, own, 0, 0)],
                             "total": [-(-int(first["total"]) // FAN**height)]})

    grouped = leaves.select("source", "block", "slot", "digest", "total").groupBy("source", "block")
    return grouped.applyInPandas(make, "source string, block long, n long, height int, layout binary, digest binary, total long")


def _levels(leaves: DataFrame, height: int) -> list[DataFrame]:
    """Levels of blocks, from below, until every tree is one block."""
    out = []
    while True:
        level = materialize(_blocks(leaves, height))
        out.append(level)
        if (level.agg(F.max("total").alias("total")).first()["total"] or 0) <= 1:
            return out
        # Only trees of several blocks go on.
        leaves = level.where("total > 1").select(
            "source", _block(F.col("block"), height).alias("block"), F.pmod("block", F.lit(FAN**height)).alias("slot"), "digest", "total")


def _block(position: Column, height: int) -> Column:
    return F.floor(position / F.lit(FAN**height)).cast("long")


def build_manifest(rows: DataFrame, leaf: Column, source_col: str = "source", id_col: str = "doc_id",
                   height: int = HEIGHT, **carried: Column) -> Manifest:
    """The manifest of ``rows``: leaves per source by ascending id, sources null first and then by UTF-8 bytes.

    ``leaf`` gives a row's digest in hex; ``carried`` names further columns to keep with the leaves. Ids that
    repeat, and null ids (which come first), are leaves of their own, ordered by digest among themselves.
    """
    named = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    leaves = rows.select(named.alias("source"), F.col(id_col).alias("doc_id"),
                         leaf.alias("leaf"), *(c.alias(name) for name, c in carried.items()))
    # Numbered through range partitions at every size, as one source may hold most rows.
    placed = materialize(row_numbers(leaves, ["doc_id", "leaf"], ["source"], "position", max_group_rows=0))
    totals = placed.groupBy("source").agg(F.count(F.lit(1)).alias("total"))
    position = F.col("position") - 1
    # One row per source: adaptive execution broadcasts it when its measured size is small, and splits a hot source
    # of a merge join otherwise.
    placed = materialize(placed.join(totals, "source").select(
        *leaves.columns, "total", _block(position, height).alias("block"), F.pmod(position, F.lit(FAN**height)).alias("slot")))
    levels = _levels(placed.withColumn("digest", F.unhex("leaf")), height)
    roots = None
    for level in levels:
        done = level.where("total = 1").select("source", F.col("digest").alias("subroot"))
        roots = done if roots is None else roots.unionByName(done)
    # Sources are numbered in byte order (Spark compares strings so).
    sources = row_numbers(roots, ["source"], out="position").select(
        "source", "subroot", _block(F.col("position") - 1, height).alias("block"),
        F.pmod(F.col("position") - 1, F.lit(FAN**height)).alias("slot"))
    sources = materialize(sources)
    total = sources.count()
    top = _levels(sources.select(F.lit("").alias("source"), "block", "slot", F.col("subroot").alias("digest"),
                                 F.lit(total).alias("total")), height)
    return Manifest(placed, levels, sources, top)


def write_manifest(manifest: Manifest, path: str) -> None:
    """Write the blocks of all levels under ``path``, in folders by tree and level."""
    for tree, levels in ((OWN, manifest.levels), (TOP, manifest.top)):
        for k, level in enumerate(levels):
            level.select("source", "block", "n", "height", "layout").write.mode("overwrite").parquet(f"{path}/tree={tree}/level={k}")


def _above(levels: list[DataFrame], height: int, of_root: DataFrame) -> DataFrame:
    """``(source, block, n, height, layout, above)`` of the lowest level; ``above`` is the path from the block's root
    to the last root. ``of_root`` is ``(source, above)``: the path from the tree's own root on."""
    paths = None
    for level in reversed(levels):
        held = level.select("source", "block", "n", "height", "layout", "total")
        last = held.where("total = 1").join(of_root, "source").select(*held.columns, "above")
        if paths is not None:
            last = last.unionByName(held.where("total > 1").join(paths, ["source", "block"]).select(*held.columns, "above"))
        lowest = level is levels[0]
        last = materialize(last.drop("total"))
        if not lowest:
            paths = materialize(_leaf_paths(last, height))
    return last


def _leaf_paths(blocks: DataFrame, height: int) -> DataFrame:
    """``(source, block, above)`` of the leaves of blocks, a leaf's number standing as ``block`` of the level below."""
    def paths(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        row = rows.iloc[0]
        n = int(row["n"])
        found = [packed(siblings(row["layout"], int(row["height"]), n, k)) + row["above"] for k in range(n)]
        return pd.DataFrame({"source": [row["source"]] * n, "block": int(row["block"]) * FAN**height + np.arange(n), "above": found})

    return blocks.groupBy("source", "block").applyInPandas(paths, "source string, block long, above binary")


def proofs(manifest: Manifest, height: int = HEIGHT) -> DataFrame:
    """The leaves with ``subroot``, ``root`` and ``path``, all siblings from a leaf to the root (see ``packed``).

    A block meets its own leaves alone; what lies above it is read once per block.
    """
    last = manifest.top[-1].select("digest").first()
    if last is None:  # an empty table
        return manifest.leaves.select("*", *[F.unhex(F.lit("")).alias(c) for c in ("subroot", "root", "path")])
    end = manifest.top[-1].select("source", F.unhex(F.lit("")).alias("above"))
    top = _leaf_paths(_above(manifest.top, height, end), height)
    number = F.col("block") * F.lit(FAN**height) + F.col("slot")
    of_source = materialize(manifest.sources.select("source", "subroot", number.alias("_number")).join(
        top.select(F.col("block").alias("_number"), "above"), "_number"))
    blocks = _above(manifest.levels, height, of_source.select("source", "above"))
    schema = manifest.leaves.select("*", F.lit(b"").alias("path")).schema

    def meet(leaves: pa.Table, block: pa.Table) -> pa.Table:
        layout, above = block["layout"][0].as_py(), block["above"][0].as_py()
        own, n = block["height"][0].as_py(), block["n"][0].as_py()
        paths = [packed(siblings(layout, own, n, k)) + above for k in leaves["slot"].to_pylist()]
        return leaves.append_column("path", pa.array(paths, pa.binary()))

    spread = target_partitions(manifest.leaves, 16 << 20)
    found = manifest.leaves.repartition(spread, "source", "block").groupBy("source", "block").cogroup(
        blocks.repartition(spread, "source", "block").groupBy("source", "block")).applyInArrow(meet, schema)
    return found.join(of_source.select("source", "subroot", F.lit(last["digest"]).alias("root")), "source")


def verify(proven: DataFrame, shown: str = "shown") -> DataFrame:
    """``proven`` with ``proof_sha256`` (of the path's siblings, in order) and ``folded_root``: what the leaf in hex
    column ``shown`` and the path lead to. A null ``shown`` gives a null root."""
    schema = proven.select("*", F.lit("").alias("proof_sha256"), F.lit("").alias("folded_root")).schema

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = [unpacked(p.as_py()) for p in batch["path"]]
            digests = [hashed([d for _, others in p for d in others]).hex() for p in paths]
            leaves = batch[shown].to_pylist()
            roots = [None if s is None else folded(bytes.fromhex(s), p).hex() for s, p in zip(leaves, paths, strict=True)]
            yield pa.record_batch([*batch.columns, pa.array(digests, pa.string()), pa.array(roots, pa.string())], names=schema.names)
        release_memory()

    return proven.mapInArrow(fold, schema)


def document_manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``documents``.

    The leaf is the digest of doc_id, source, lang, n_chars and text. ``folded_root`` starts from the row as it would
    be after tampering: where 2 divides the crc32 of the decimal doc_id, its text has lost its line feeds. Rows
    with a null id are not tampered with; null texts stay null. Rows that repeat an id are leaves of their own,
    ordered by their digests. A null source is a tree of its own. Other columns are ignored; an empty table gives
    no rows.
    """
    doc_id = F.col("doc_id").cast("long")
    given = [doc_id, F.col("source"), F.col("lang"), F.col("n_chars")]
    leaf = leaf_digest(*given, F.col("text"))
    tampered = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    shown = F.when(tampered, leaf_digest(*given, F.replace(F.col("text"), F.lit("\n"), F.lit("")))).otherwise(leaf)
    found = verify(proofs(build_manifest(docs, leaf, height=height, shown=shown), height))
    return found.select(F.col("doc_id").cast("long").alias("doc_id"), "leaf", F.lower(F.hex("subroot")).alias("subroot"), F.lower(F.hex("root")).alias("root"),
                        "proof_sha256", "folded_root",
                        (F.col("folded_root") == F.lower(F.hex("root"))).alias("verified"))
