"""Link graph: degrees, in-link sets, multiplicities, bounded crawl and PageRank.

PageRank follows the reference's formula exactly (synchronous sweeps):

    score(d) = (1 - damping) / N + damping * sum over distinct in-links s of score(s) / outdeg(s)

where N is the number of documents with out-links, outdeg counts duplicate
edges, only documents with out-links get a score, and every score starts at
``initial_pr``.

Plan per sweep: the distinct edges are written once as a table bucketed by
``(from_id, salt)`` and the sources as a table bucketed by ``from_id`` (both
in the checkpoint folder), so neither moves again; each sweep shuffles only
the per-source contributions (one row per source, a few more for hot
sources; broadcast instead when the planner measures them small) and the
partially aggregated sums by target. A source with more
distinct out-links than one partition's fair share is "hot": its edges are
salted over all partitions by target, and its contribution row is replicated
once per salt, so no task carries a hot source's whole edge list.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.operators.distribute import row_numbers
from webloom.operators.index import posting_blocks
from webloom.session import bucketed, cut_lineage, materialize, target_partitions, write_table

DAMPING = 0.85


def out_degree(edges: DataFrame) -> DataFrame:
    """``(from_id, outdeg)`` counting duplicate edges."""
    return edges.groupBy("from_id").agg(F.count(F.lit(1)).cast("bigint").alias("outdeg"))


def in_links(edges: DataFrame) -> DataFrame:
    """Distinct in-link sets per target, in bounded blocks ``(to_id, block_no, n_from, from_ids)``."""
    blocks = posting_blocks(edges.select("to_id", "from_id").distinct(), key="to_id", value="from_id")
    return blocks.withColumnRenamed("n_docs", "n_from").withColumnRenamed("doc_ids", "from_ids")


def link_counts(edges: DataFrame) -> DataFrame:
    """Number of links between two pages ``(from_id, to_id, n_links)``."""
    return edges.groupBy("from_id", "to_id").agg(F.count(F.lit(1)).cast("bigint").alias("n_links"))


def crawl_frontier(seeds: DataFrame, edges: DataFrame, depth: int = 1) -> DataFrame:
    """G5 + G6: breadth-first reachability ``(id, depth)`` with the minimum depth, up to ``depth``.

    Seeds have depth 0; targets of a depth-d node get d + 1; a node is taken
    once (anti-join against everything already visited); nodes deeper than
    ``depth`` are never expanded. Each level's frontier is written as a table so the
    plan does not grow with the depth.
    """
    frontier = seeds.select(F.col("id")).distinct().withColumn("depth", F.lit(0))
    frontier = materialize(frontier)
    levels = [frontier]
    visited = frontier.select("id")
    for d in range(1, depth + 1):
        nxt = (
            frontier.select(F.col("id").alias("from_id"))
            .join(edges.select("from_id", "to_id"), "from_id")
            .select(F.col("to_id").alias("id"))
            .distinct()
            .join(visited, "id", "left_anti")
            .withColumn("depth", F.lit(d))
        )
        frontier = materialize(nxt)
        levels.append(frontier)
        visited = visited.unionByName(frontier.select("id"))
    out = levels[0]
    for lvl in levels[1:]:
        out = out.unionByName(lvl)
    return out.select("id", F.col("depth").cast("int").alias("depth"))


def page_rank(
    edges: DataFrame,
    num_iterations: int = 20,
    initial_pr: float = 1.0,
    damping: float = DAMPING,
    tol: float | None = None,
    max_iterations: int = 200,
    checkpoint_every: int = 5,
) -> DataFrame:
    """``(doc_id, score)`` for every document with out-links.

    ``tol=None`` runs exactly ``num_iterations`` sweeps (the reference's
    contract). With ``tol`` set, sweeps continue until the sum of changes in a
    sweep is below ``tol`` times the sum of scores, whatever the graph's size;
    ``NotConverged`` with the last such share is raised when
    ``max_iterations`` sweeps do not get there. After each such check all scores are
    balanced (``_balanced``): the sum of scores, which plain sweeps bring to its limit
    by 15 % at a time, gets there at once, so the sweeps left do not grow with the graph.
    """
    spark = edges.sparkSession
    e = edges.select(F.col("from_id").cast("bigint"), F.col("to_id").cast("bigint"))

    # One pass over the input: distinct links with their multiplicity. Out-degree
    # counts duplicates (sum of multiplicities); in-links use distinct links.
    path = write_table(e.groupBy("from_id", "to_id").agg(F.count(F.lit(1)).alias("_m")))
    # The sweeps run in a session of their own: buckets of the edge and rank tables and the sums'
    # shuffle share one partition count, sized from the link table, and the plans are fixed
    # (co-partitioned joins), so adaptive re-planning would only add latency. The caller's settings stay.
    own = spark.newSession()
    n_parts = target_partitions(spark.read.parquet(path))
    own.conf.set("spark.sql.shuffle.partitions", str(n_parts))
    own.conf.set("spark.sql.adaptive.enabled", "false")
    made: list[str] = []
    try:
        ranks = _page_rank(own, own.read.parquet(path), n_parts, num_iterations, initial_pr, damping, tol, max_iterations,
                           checkpoint_every, made)
        return spark.read.parquet(write_table(ranks))
    finally:
        # Unregister the work tables made here (external tables: only the catalog entries go).
        for name in made:
            own.sql(f"DROP TABLE IF EXISTS `{name}`")


class NotConverged(RuntimeError):
    """The sweeps ended before the scores settled; ``residual`` is the last sweep's share of change."""

    def __init__(self, residual: float, sweeps: int) -> None:
        super().__init__(f"scores still change by {residual:.3g} of their sum after {sweeps} sweeps")
        self.residual, self.sweeps = residual, sweeps


def _page_rank(spark, multi, n_parts, num_iterations, initial_pr, damping, tol, max_iterations, checkpoint_every, made):
    links = multi.select("from_id", "to_id")
    per_src = materialize(
        multi.groupBy("from_id").agg(F.sum("_m").cast("double").alias("outdeg"), F.count(F.lit(1)).alias("_k"))
    )
    totals = per_src.agg(F.sum("_k").alias("links"), F.count(F.lit(1)).alias("docs")).first()
    n_links, n_docs = totals["links"] or 0, totals["docs"]
    if n_links == 0:
        return spark.createDataFrame([], T.StructType([
            T.StructField("doc_id", T.LongType()), T.StructField("score", T.DoubleType())]))
    # Hot sources: more distinct out-links than a partition's fair share.
    # At most n_parts of them exist, so the hot table is bounded by n_parts rows.
    fair_share = max(1, n_links // n_parts)
    hot = per_src.where(F.col("_k") > F.lit(fair_share)).select("from_id", F.lit(True).alias("hot"))
    sources = per_src.select("from_id", "outdeg")
    lead = (1.0 - damping) / float(n_docs)
    sweeps = max_iterations if tol is not None else num_iterations

    if hot.count() == 0:
        ranks = _sweeps_copartitioned(links, sources, n_parts, sweeps, initial_pr, damping, lead, tol,
                                      checkpoint_every, made)
    else:
        ranks = _sweeps_salted(links, sources, F.broadcast(hot), n_parts, sweeps, initial_pr, damping, lead, tol,
                               checkpoint_every, made)
    return ranks.select(F.col("from_id").alias("doc_id"), "score")


def _residual(new_ranks: DataFrame, old_ranks: DataFrame) -> tuple[float, float]:
    """The sum of a sweep's changes, as a share of the sum of scores, and by how much the sweep raised that sum."""
    sums = (
        new_ranks.alias("n").join(old_ranks.alias("o"), "from_id")
        .agg(F.sum(F.abs(F.col("n.score") - F.col("o.score"))).alias("change"), F.sum("n.score").alias("all"),
             F.sum("o.score").alias("before"))
        .first()
    )
    return (sums["change"] / sums["all"], sums["all"] - sums["before"]) if sums["all"] else (0.0, 0.0)


def _balanced(ranks: DataFrame, lead: float, damping: float, raised: float) -> DataFrame:
    """What a sweep gives from the same scores times the one factor with which it leaves their sum as it is.

    A sweep of ``a * x`` gives ``lead + a * (y - lead)`` where it gives ``y`` for ``x``, and all leads sum to
    ``1 - damping``. So one sweep tells the factor, and the outcome needs no other.
    """
    leads = 1.0 - damping
    factor = leads / (leads - raised) if leads > 0.0 and leads - raised > 0.0 else 1.0
    return ranks.withColumn("score", F.lit(lead) + F.lit(factor) * (F.col("score") - F.lit(lead)))


def _sweeps_copartitioned(links, sources, n_parts, sweeps, initial_pr, damping, lead, tol, checkpoint_every, made):
    """No hot source: edges, sources and rank snapshots are all bucketed by ``from_id``.

    Every join is then co-partitioned (shuffled-hash joins on bucketed sides),
    so a sweep has exactly one exchange: the partially aggregated sums by target. Edges
    lie in target order inside a bucket, so a target's sum is still at hand when its next
    edge comes, however many targets there are.
    """
    edges = bucketed(links.select("from_id", "to_id"), n_parts, "from_id", names=made, order="to_id")
    srcs = bucketed(sources.select("from_id", "outdeg"), n_parts, "from_id", names=made)
    ranks = srcs.withColumn("score", F.lit(float(initial_pr)))
    residual = math.inf
    for i in range(sweeps):
        contrib = ranks.select("from_id", (F.col("score") / F.col("outdeg")).alias("c"))
        sums = (
            edges.join(contrib.hint("shuffle_hash"), "from_id")
            .groupBy("to_id").agg(F.sum("c").alias("t"))
            .withColumnRenamed("to_id", "from_id")
        )
        new_ranks = srcs.join(sums.hint("shuffle_hash"), "from_id", "left").select(
            "from_id", "outdeg", (F.lit(lead) + F.lit(damping) * F.coalesce(F.col("t"), F.lit(0.0))).alias("score")
        )
        last = i + 1 == sweeps
        if tol is not None and (i + 2) % checkpoint_every == 0 and not last:
            # Snapshot sweep k-1 so the check after sweep k compares consecutive sweeps.
            new_ranks = bucketed(new_ranks, n_parts, "from_id", names=made)
        elif tol is not None and (i + 1) % checkpoint_every == 0:
            new_ranks = bucketed(new_ranks, n_parts, "from_id", names=made)
            residual, raised = _residual(new_ranks, ranks)
            if residual < tol:
                return new_ranks
            ranks = _balanced(new_ranks, lead, damping, raised)
            continue
        elif tol is None and (i + 1) % checkpoint_every == 0 and not last:
            # Cut lineage with a bucketed snapshot, which keeps the co-partitioning.
            new_ranks = bucketed(new_ranks, n_parts, "from_id", names=made)
        ranks = new_ranks
    if tol is not None:
        raise NotConverged(residual, sweeps)
    return ranks


def _sweeps_salted(links, sources, hot, n_parts, sweeps, initial_pr, damping, lead, tol, checkpoint_every, made):
    """Hot sources present: their edges are salted over all partitions by target and
    their contribution rows replicated once per salt; edges are bucketed by (from_id, salt)."""
    salted = links.join(hot, "from_id", "left").select(
        "from_id",
        "to_id",
        F.when(F.col("hot"), F.pmod(F.xxhash64("to_id"), F.lit(n_parts))).otherwise(F.lit(0)).cast("int").alias("salt"),
    )
    salted = bucketed(salted, n_parts, "from_id", "salt", names=made)
    srcs = sources.join(hot, "from_id", "left").select(
        "from_id", "outdeg", F.coalesce(F.col("hot"), F.lit(False)).alias("hot")
    )
    srcs = bucketed(srcs, n_parts, "from_id", names=made)
    all_salts = F.sequence(F.lit(0), F.lit(n_parts - 1))

    ranks = srcs.withColumn("score", F.lit(float(initial_pr)))
    residual = math.inf
    for i in range(sweeps):
        contrib = ranks.select(
            "from_id",
            (F.col("score") / F.col("outdeg")).alias("c"),
            F.explode(F.when(F.col("hot"), all_salts).otherwise(F.array(F.lit(0)))).alias("salt"),
        )
        sums = (
            salted.join(contrib, ["from_id", "salt"])
            .groupBy("to_id")
            .agg(F.sum("c").alias("t"))
            .withColumnRenamed("to_id", "from_id")
        )
        new_ranks = srcs.join(sums, "from_id", "left").select(
            "from_id",
            "outdeg",
            "hot",
            (F.lit(lead) + F.lit(damping) * F.coalesce(F.col("t"), F.lit(0.0))).alias("score"),
        )
        if tol is not None:
            new_ranks = cut_lineage(new_ranks)
            residual, raised = _residual(new_ranks, ranks)
            if residual < tol:
                return new_ranks
            ranks = _balanced(new_ranks, lead, damping, raised)
        else:
            ranks = new_ranks
            if (i + 1) % checkpoint_every == 0 and i + 1 < sweeps:
                ranks = cut_lineage(ranks)
    if tol is not None:
        raise NotConverged(residual, sweeps)
    return ranks


def rank_report(ranks: DataFrame, doc_index: DataFrame) -> DataFrame:
    """``(rank, url, score)``, score descending (as it is, not rounded), ties by url."""
    joined = ranks.join(doc_index, "doc_id").select("url", "score")
    return row_numbers(joined, order_by=[F.col("score").desc(), F.col("url")], out="rank").select(
        "rank", "url", "score"
    )
