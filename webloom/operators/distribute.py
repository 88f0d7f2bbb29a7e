"""Distribution helpers shared by the operators.

``row_numbers`` gives 1-based positions in a total order, optionally within
groups, without a window that pulls an unbounded group (or the whole table)
into one task: rows are range-partitioned and sorted on the ordering keys,
each partition numbers its own rows, and per-partition offsets (one row per
partition and group) are added back. A hot group simply spans several range
partitions. When the largest group is counted and found small, a plain
window per group is used instead (cheaper, and bounded by the check).

``broadcast_if_small`` broadcasts a side only after counting it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.session import materialize, target_partitions

# Largest row count broadcast without further thought (checked by counting).
DEFAULT_BROADCAST_ROWS = 2_000_000
# Largest group numbered by a plain window (checked by counting); bigger groups
# are numbered through range partitions.
MAX_WINDOW_GROUP_ROWS = 1_000_000


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Count ``df``; broadcast it when within ``max_rows``, otherwise return it
    unchanged so the planner shuffles both sides. Returns ``(df, broadcast?)``."""
    n = df.count()
    return (F.broadcast(df), True) if n <= max_rows else (df, False)


def row_numbers(
    df: DataFrame,
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    out: str = "rn",
    max_group_rows: int = MAX_WINDOW_GROUP_ROWS,
    written: bool = False,
) -> DataFrame:
    """Add ``out`` = 1-based row number within ``partition_by`` groups.

    ``order_by`` must make the order total inside a group (add a unique
    tie-break) so the numbering is deterministic. With groups, the largest
    group is counted first: when every group is within ``max_group_rows`` a
    plain window per group is used (a bounded sort per group); otherwise, and
    always without groups, rows are numbered through range partitions.
    ``written``: ``df`` comes from written tables and need not be written to be read twice.
    """
    spark = df.sparkSession
    groups = list(partition_by)
    if groups:
        df = df if written else materialize(df)  # read twice below (size check, numbering)
        biggest = df.groupBy(*groups).count().agg(F.max("count")).first()[0] or 0
        if biggest <= max_group_rows:
            w = Window.partitionBy(*groups).orderBy(*[_as_col(c) for c in order_by])
            return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    n = target_partitions(df)
    keys = [F.col(g) for g in groups] + [_as_col(c) for c in order_by]

    ordered = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_p", F.spark_partition_id())
        .withColumn("_m", F.monotonically_increasing_id())
    )
    # Partition ids and row ids are non-deterministic expressions; fix them
    # once (a table in the shared checkpoint folder) before they are used twice.
    ordered = materialize(ordered)

    stats = ordered.groupBy("_p", *groups).agg(
        F.min("_m").alias("_m0"), F.count(F.lit(1)).alias("_c")
    )
    if groups:
        # One stats row per (partition, group): a group has at most n of them,
        # so this window's groups are bounded by the partition count.
        w = Window.partitionBy(*groups).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        stats = stats.select("_p", *groups, "_m0", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
        # The stats are an aggregation output: adaptive execution measures their
        # size when that stage finishes and broadcasts them only if small
        # (otherwise a sort-merge join); no separate counting job is needed.
    else:
        # Without groups there is one stats row per partition (at most n): the
        # running offsets are computed from those n counts, as zipWithIndex does.
        rows = sorted(stats.collect(), key=lambda r: r["_p"])
        offsets, total = [], 0
        for r in rows:
            offsets.append((r["_p"], r["_m0"], total))
            total += r["_c"]
        stats = F.broadcast(spark.createDataFrame(offsets, "_p int, _m0 long, _off long"))
    return (
        ordered.join(stats, on=["_p", *groups], how="inner")
        .withColumn(out, (F.col("_m") - F.col("_m0") + F.col("_off") + F.lit(1)).cast("bigint"))
        .drop("_p", "_m", "_m0", "_off")
    )
