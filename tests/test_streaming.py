"""The streamed history equals the batch history over the same log."""

import os
import tempfile

from pyspark.sql import functions as F

from webloom.operators import history
from webloom.sources import tables
from webloom.streaming.history_stream import current_view, start_history_stream

from sf_paths import SF_SMALL


def test_stream_matches_batch(spark):
    work = tempfile.mkdtemp(prefix="wl-stream-")
    src = os.path.join(work, "log")
    log = tables.search_log(spark, SF_SMALL)
    turns = sorted(r.seq for r in log.select("seq").distinct().collect())
    # Arrival order: one file per turn, written in turn order (the whole log is sent).
    for t in turns:
        log.where(F.col("seq") == t).coalesce(1).write.mode("append").parquet(src)
    out = os.path.join(work, "out")
    start_history_stream(spark, src, out, os.path.join(work, "ckpt")).awaitTermination(300)
    batch = max(int(x.partition("=")[2]) for x in os.listdir(os.path.join(out, "totals")))
    totals = {(r.user_id, r.word): r.n for r in current_view(spark, out, "totals", batch).collect()}
    want_totals = {(r.user_id, r.word): r.n for r in history.history_counts(log).collect()}
    assert totals == want_totals
    recent = sorted((r.user_id, r.rank, r.word) for r in current_view(spark, out, "recent", batch).collect())
    want_recent = sorted((r.user_id, r.rank, r.word) for r in history.recent_words(log).collect())
    assert recent == want_recent
