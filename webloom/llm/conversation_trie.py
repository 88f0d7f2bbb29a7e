"""The prefix trie of conversations, from whole sequences.

Identical rebuilt conversations collapse into one weighted sequence with a list of its ends. Sequences that are
proper prefixes of others fall away by an anti-join, which leaves the trie's leaves. Every statistic of a node is
then a sum over the weighted prefixes of distinct sequences: copies cost nothing beyond the collapse.

A prefix is known by a sum over its turns of 128-bit parts of SHA-256(position, role, text). A sum over positions can
be taken piece by piece, so a conversation of any length is summed in pieces of bounded size, and the pieces' sums
are carried on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import materialize, release_memory
from webloom.operators.distribute import row_numbers
from webloom.session import target_partitions

#: Conversations whose number leaves the same multiple share that multiple's first turns: at most ``HEADS - 1``.
FAMILY, HEADS = 5, 9
#: Turns summed in one window, and conversations per row of an end list.
PIECE, LISTED = 1024, 512
#: Four sums of 32-bit parts make a prefix's key.
PARTS = range(4)
ROOT = bytes(16)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, turn_id, bytes)``: turns of each conversation numbered from 0 by turn, null first. Equal
    turn numbers go by role, then by the text's SHA-256. ``turn_id`` is the digest of role and text."""
    role = F.coalesce(F.col("role"), F.lit(""))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), role.alias("role"),
        F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    # Range partitions at every size, as one conversation may hold most rows.
    placed = row_numbers(rows, ["turn", "role", "digest"], ["conv_id"], "place", max_group_rows=0)
    parts = [F.octet_length("role").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("role").cast("binary"), F.col("digest")]
    return placed.select("conv_id", (F.col("place") - 1).alias("place"), F.unhex(F.sha2(F.concat(*parts), 256)).alias("turn_id"), "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, length)`` of all conversations, and ``(conv_id, place, turn_id, bytes, length)`` of their turns.

    The first h turns of conversation c come from conversation c - c % 5 (all of them if fewer, none if there is no
    such conversation), the others are its own from its h-th on; h is crc32(c) % 9.
    """
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(HEADS)
    convs = counts.select("conv_id", "n", heads.alias("h"), (F.col("conv_id") - F.col("conv_id") % F.lit(FAMILY)).alias("base"))
    bases = counts.where(F.col("conv_id") % F.lit(FAMILY) == 0).select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    shared = F.least("h", F.coalesce("n_base", F.lit(0)))
    convs = materialize(convs.join(bases, "base", "left").select(
        "conv_id", "base", "h", shared.alias("shared"), (shared + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    first = turns.where((F.col("conv_id") % F.lit(FAMILY) == 0) & (F.col("place") < HEADS - 1)).withColumnRenamed("conv_id", "base")
    # A base's few first turns go to at most five conversations.
    taken = first.join(convs, "base").where("place < h").select("conv_id", "place", "turn_id", "bytes", "length")
    own = turns.join(convs, "conv_id").where("place >= h").select(
        "conv_id", (F.col("shared") + F.col("place") - F.col("h")).alias("place"), "turn_id", "bytes", "length")
    return convs.select("conv_id", "length"), taken.unionByName(own)


def _key(sums: list[Column]) -> Column:
    return F.unhex(F.concat(*[F.lpad(F.hex(s % F.lit(1 << 32)), 8, "0") for s in sums]))


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, depth, key, parent, bytes, before, length)`` per turn: the keys of the prefix that it ends and of
    the one before it, the text's bytes and those before it."""
    digest = F.sha2(F.concat(F.col("place").cast("string").cast("binary"), F.lit(":").cast("binary"), F.col("turn_id")), 256)
    held = turns.withColumn("_digest", digest).select(
        "conv_id", "place", "bytes", "length", F.floor(F.col("place") / PIECE).cast("long").alias("piece"),
        *[F.conv(F.substring("_digest", 8 * k + 1, 8), 16, 10).cast("long").alias(f"p{k}") for k in PARTS])
    held = materialize(held)
    summed = [f"p{k}" for k in PARTS] + ["bytes"]
    sums = held.groupBy("conv_id", "piece").agg(*[F.sum(c).alias(c) for c in summed])
    # Sums before each piece: a row per piece, and only of conversations with several.
    long = held.where("piece > 0").select("conv_id").distinct()
    earlier = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.join(long, "conv_id").select(
        "conv_id", "piece", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in summed])
    inside = Window.partitionBy("conv_id", "piece").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    running = held.select("*", *[F.sum(c).over(inside).alias(f"{c}_so_far") for c in summed]).join(before, ["conv_id", "piece"], "left")
    upto = {c: F.col(f"{c}_so_far") + F.coalesce(f"{c}_before", F.lit(0)) for c in summed}
    return running.select(
        "conv_id", (F.col("place") + 1).alias("depth"), _key([upto[f"p{k}"] for k in PARTS]).alias("key"),
        _key([upto[f"p{k}"] - F.col(f"p{k}") for k in PARTS]).alias("parent"), "bytes",
        (upto["bytes"] - F.col("bytes")).alias("before"), "length")


def end_digests(ends: DataFrame) -> DataFrame:
    """``(depth, key, ends_sha256)``: SHA-256 of the ascending decimal conv_ids of each sequence, joined by commas.

    Ids are numbered through range partitions and joined by some hundreds; the digest then passes over those rows in
    order, whatever the list's length.
    """
    at = row_numbers(ends.select("depth", "key", "conv_id"), ["conv_id"], ["depth", "key"], "place", max_group_rows=0)
    block = F.floor((F.col("place") - 1) / LISTED).cast("long")
    blocks = at.groupBy("depth", "key", block.alias("block")).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    texts = blocks.select("depth", "key", "block", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("text"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(done: list) -> pa.RecordBatch:
            return pa.record_batch([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.binary()),
                                    pa.array([d[2] for d in done], pa.string())], names=["depth", "key", "ends_sha256"])

        node, running, done = None, None, []
        for batch in batches:
            for depth, key, text in zip(*(batch[c].to_pylist() for c in ("depth", "key", "text")), strict=True):
                if node == (depth, key):
                    running.update(b"," + text.encode())
                    continue
                if node is not None:
                    done.append((*node, running.hexdigest()))
                node, running = (depth, key), hashlib.sha256(text.encode())
            yield rows(done)
            done = []
        if node is not None:
            yield rows([(*node, running.hexdigest())])
        release_memory()

    dealt = texts.repartition(target_partitions(texts), "depth", "key").sortWithinPartitions("depth", "key", "block")
    return dealt.mapInArrow(digest, "depth long, key binary, ends_sha256 string")


def sequences(convs: DataFrame, pre: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The collapse: ``(depth, key, conv_id)`` of where each conversation ends, and its distinct sequences
    ``(depth, key, conv_id, weight, total)`` with the smallest conversation, their number and their texts' bytes."""
    ends = pre.where("depth = length").select("depth", "key", "conv_id", (F.col("before") + F.col("bytes")).alias("total"))
    none = convs.where("length = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"), "conv_id",
                                            F.lit(0).cast("long").alias("total"))
    ends = materialize(ends.unionByName(none))
    found = ends.groupBy("depth", "key").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"),
                                             F.max("total").alias("total"))
    return ends, materialize(found)


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Null roles and texts count as empty; a null turn comes first; turns of equal number go by role, then by the SHA-256
    of the text; repeated rows are turns of their own. Rows without a conv_id belong to no conversation. A very long
    conversation, and one that very many repeat, are spread over tasks. Other columns are ignored; without any
    conversation there is no node.
    """
    turns = materialize(numbered_turns(conversations))
    convs, placed = rebuilt(turns)
    pre = materialize(prefixes(placed))
    ends, seqs = sequences(convs, pre)
    node = ["depth", "key"]

    # Prefixes of distinct sequences alone, each sequence by its smallest conversation.
    own = seqs.select("conv_id", "weight", "total")
    paths = pre.join(own, "conv_id").select("conv_id", *node, "parent", "bytes", (F.col("total") - F.col("before")).alias("rest"), "weight", "length")
    start = seqs.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"),
                        F.lit(0).cast("long").alias("bytes"), F.col("total").alias("rest"), "weight", F.col("depth").alias("length"))
    paths = materialize(paths.unionByName(start))
    proper = paths.where("depth < length").select(*node).distinct()
    leaves = seqs.join(proper, node, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
    weighted = paths.join(leaves, "conv_id", "left").groupBy(*node).agg(
        F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.coalesce(F.sum("leaf"), F.lit(0)).alias("n_leaves"),
        F.sum(F.col("weight") * F.col("rest")).alias("read"), F.min("parent").alias("parent"), F.min("bytes").alias("bytes"))
    nodes = materialize(weighted)

    # A node belongs to its smallest conversation, which holds all deeper nodes of its sequence from its first one
    # on. So the distinct bytes below a node are again a sum over sequences.
    held = nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.sum("bytes").alias("owned"))
    below = F.when(F.col("depth") >= F.col("first"), F.col("rest")).otherwise(F.col("owned"))
    distinct = paths.select("conv_id", *node, "rest").join(held, "conv_id").groupBy(*node).agg(F.sum(below).alias("stored"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children"))

    # A parent belongs to the same conversation, but for a conversation's first node.
    smallest = nodes.where("depth = 0").select("conv_id").first()
    top = F.lit(smallest[0] if smallest else None).cast("long")
    firsts = nodes.join(held.select("conv_id", "first"), "conv_id").where("depth = first and depth > 1").select(*node, (F.col("depth") - 1).alias("up"), "parent")
    parents = firsts.join(nodes.select(F.col("depth").alias("up"), F.col("key").alias("parent"), F.col("conv_id").alias("other")),
                          ["up", "parent"]).select(*node, "other")
    parent_conv = F.when(F.col("depth") == 1, top).when(F.col("depth") > 1, F.coalesce("other", "conv_id"))

    none = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(distinct, node, "left").join(children, node, "left").join(parents, node, "left").join(end_digests(ends), node, "left")
        .select("conv_id", "depth", parent_conv.alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
                F.col("n_leaves").cast("long").alias("n_leaves"), (F.col("read") - F.coalesce("stored", F.lit(0))).alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))
