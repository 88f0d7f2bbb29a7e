"""Benchmark: run the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma-separated subset, optional).

Each query is executed to Spark's ``noop`` sink, so the whole result is
computed but nothing is collected to the driver. Before timing, every
headline query runs once untimed on the smallest sibling data folder
(``sf0.001`` when present): that pays the one-time JVM warm-up and code
generation, which a long-running cluster session pays once, not per query.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from webloom.plans.catalog import QUERIES  # noqa: E402
from webloom.session import local_session  # noqa: E402

HEADLINE = [
    "inverted_index",
    "page_rank",
    "search",
    "spell_correct",
    "resolved_index",
    "rank_report",
    "search_with_fallback",
    "history_top20",
    "recent_words",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = local_session(cpus, shuffle_partitions=max(8, cpus), app="webloom-bench")
    # Warm-up: JVM start, class loading and code generation outside the timings.
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in names:
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "warmup": os.path.basename(warm_dir.rstrip("/")),
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
