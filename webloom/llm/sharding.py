"""Sharding by minimax contiguous partition, JVM-side throughout.

Equal texts form an atomic group. Groups are ordered (by their smallest id), their sizes summed up in that
order, and the smallest capacity with which a greedy walk fits all groups into the shards is found by search:
each round tries several capacities at once, one aggregation per shard, on the running sums alone. The final
cuts keep that capacity and, within it, bring every shard as near to an equal share as the groups allow.

No group of rows is gathered: groups are aggregated map-side, running sums come from range partitions with one
offset each, and only a few numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webloom.llm.common import materialize, partition_offsets
from webloom.operators.distribute import row_numbers
from webloom.session import target_partitions

SHARDS = 8
#: Capacities tried per round of the search.
TRIED = 24


def running_sums(groups: DataFrame, order: list[str], amount: str) -> DataFrame:
    """``groups`` with ``upto``, the running sum of ``amount`` in ``order``; written, in that order."""
    parts = materialize(
        groups.repartitionByRange(target_partitions(groups), *order).sortWithinPartitions(*order)
        .withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    )
    before = partition_offsets(parts.groupBy("_p").agg(F.sum(amount).alias(amount)), "_p", [amount])
    w = Window.partitionBy("_p").orderBy("_m")
    return materialize(
        parts.withColumn("upto", F.sum(amount).over(w)).join(F.broadcast(before), "_p")
        .withColumn("upto", F.col("upto") + F.col(f"{amount}_before"))
        .select(*groups.columns, "upto")
    )


class _Boundaries:
    """Positions at which groups end, asked for by one aggregation for several positions at once."""

    def __init__(self, sums: DataFrame, total: int) -> None:
        self.sums, self.total = sums.select("upto"), total

    def last_up_to(self, xs: list[int], bases: list[int]) -> list[int]:
        """For each x the last boundary up to it, at least its base."""
        near = self.sums.where((F.col("upto") > min(bases)) & (F.col("upto") <= max(xs)))
        got = near.agg(*[F.max(F.when(F.col("upto") <= x, F.col("upto"))).alias(f"x{i}") for i, x in enumerate(xs)]).first()
        return [max(b, g or 0) for g, b in zip(got, bases, strict=True)]

    def first_from(self, x: int) -> int:
        """The first boundary (0 is one) at or after x."""
        return 0 if x <= 0 else self.sums.where(F.col("upto") >= x).agg(F.min("upto")).first()[0]


def smallest_capacity(at: _Boundaries, largest: int, shards: int) -> int:
    """The least capacity with which a greedy walk needs no more than ``shards`` shards."""
    low = max(largest, -(-at.total // shards))
    high = low + largest  # always enough: a shard left below its share lacks less than one group
    while low < high:
        step = max(1, (high - low) // TRIED)
        tried = list(range(low, high, step))
        ends = [0] * len(tried)
        for _ in range(shards - 1):
            ends = at.last_up_to([e + c for e, c in zip(ends, tried, strict=True)], ends)
        fits = [at.total - e <= c for e, c in zip(ends, tried, strict=True)]
        k = fits.index(True) if any(fits) else len(tried)
        low, high = (tried[k - 1] + 1 if k else low), (tried[k] if k < len(tried) else high)
    return high


def cut_points(at: _Boundaries, capacity: int, shards: int) -> list[int]:
    """``shards - 1`` cuts: no shard above ``capacity``, each as near as it goes to its share of the rest."""
    needed = [at.total]  # from the back: the earliest cut that leaves enough room behind it
    for _ in range(shards - 1):
        needed.append(at.first_from(needed[-1] - capacity))
    cuts, base = [], 0
    for k, least in zip(range(shards, 1, -1), reversed(needed[1:]), strict=True):
        most = base + capacity
        wish = min(max(base + (at.total - base) // k, least), most)
        before, after = at.last_up_to([wish], [max(base, least)])[0], at.first_from(wish)
        # The nearer one, but no shard stays empty while groups are left.
        base = after if after <= most and (after - wish < wish - before or before == base) else before
        cuts.append(base)
    return cuts


def shard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """One row per input row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Size is the text's UTF-8 bytes plus 1 (null: 1); sizes per shard are near equal, law ``bytes``. Equal texts
    share a shard (null counts as empty). ``slot`` counts a shard's rows from 0 without gaps, repeated rows
    included. A single group above an equal share sets the capacity; an empty table gives an empty result.
    """
    whole = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(whole) + 1).cast("long").alias("size"),
        F.crc32(F.encode(whole, "UTF-8")).alias("text_crc32"), F.unhex(F.sha2(whole, 256)).alias("same")))
    sums = running_sums(
        rows.groupBy("same").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("bytes")),
        ["first_id", "same"], "bytes")
    total, largest = sums.agg(F.max("upto"), F.max("bytes")).first()
    at = _Boundaries(sums, total or 0)
    cuts = cut_points(at, smallest_capacity(at, largest, shards), shards) if total else []
    number = F.lit(0)
    for c in cuts:
        number = number + (F.col("upto") > c).cast("int")
    placed = rows.join(sums.select("same", "first_id", number.alias("shard")), "same")
    numbered = materialize(row_numbers(placed, ["shard", "first_id", "same", "doc_id"], out="n"))
    starts = partition_offsets(numbered.groupBy("shard").agg(F.count(F.lit(1)).alias("rows")), "shard", ["rows"])
    return numbered.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("n") - 1 - F.col("rows_before")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
