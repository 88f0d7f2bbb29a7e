"""Connected components of a table of links, as DataFrame jobs.

Each round hooks every node to its smallest neighbour, follows that one's hook as well, and contracts the links
to those nodes; links within a contracted node vanish and equal ones merge, so rounds shrink quickly and a path
of n links is done in about log(n) of them. Hooks come from a map-side combined aggregation; joins on a hub are
ordinary equi-joins, which adaptive execution splits when skewed. Each round is written to the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import discard, materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links`` (its first two columns): the smallest node it is linked with,
    directly or not. Links that repeat or join a node to itself do no harm."""
    a, b = links.columns[:2]
    left = materialize(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct())
    labels = None
    while True:
        down = left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label"))
        # A node that is never the larger end is the smallest of its neighbourhood.
        hooks = left.select(F.col("a").alias("node"), F.col("a").alias("label")).unionByName(down).groupBy("node").agg(
            F.min("label").alias("label"))
        hooks = materialize(hooks)
        further = hooks.select(F.col("node").alias("_via"), F.col("label").alias("_further"))
        first = hooks
        hooks = materialize(hooks.join(further, F.col("label") == F.col("_via")).select("node", F.col("_further").alias("label")))
        discard(first)
        if labels is None:
            labels = hooks
        else:
            older = labels
            moved = hooks.select(F.col("node").alias("_old"), F.col("label").alias("_new"))
            labels = materialize(labels.join(moved, F.col("label") == F.col("_old"), "left").select(
                "node", F.coalesce("_new", "label").alias("label")))
            discard(older)
        ends = [hooks.select(F.col("node").alias(f"_{x}"), F.col("label").alias(f"_to_{x}")) for x in "ab"]
        before = left
        left = materialize(
            left.join(ends[0], F.col("a") == F.col("_a")).join(ends[1], F.col("b") == F.col("_b"))
            .where("_to_a <> _to_b").select(F.least("_to_a", "_to_b").alias("a"), F.greatest("_to_a", "_to_b").alias("b")).distinct())
        discard(before)
        if left.isEmpty():
            return labels
