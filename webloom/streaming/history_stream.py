"""Search-log history kept up to date by Structured Streaming (H2 + H4 as searches arrive).

A stream of log rows ``(user_id, seq, text)`` (files appearing in a folder, e.g. one per minute of traffic) is
handled batch by batch (``foreachBatch``): the batch's words are counted and folded, with the same column
expressions as the batch operators, into the tables that the batch before has left. Each batch writes whole
tables under its own number, so a batch that is replayed writes the same rows again instead of adding any.
Rows of one user are assumed to arrive in ``seq`` order across batches (an append-only log).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from webloom.operators.history import QUEUE_SCHEMA, RECENT_WORDS, advance_queues, log_words, queue_ranks

LOG_SCHEMA = "user_id long, seq long, text string"
TOTALS_SCHEMA = "user_id long, word string, n long"


def _table(out_dir: str, name: str, batch: int) -> str:
    return f"{out_dir.rstrip('/')}/{name}/batch={batch}"


def _fold_batch(out_dir: str, k: int):
    def fold(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = {
            name: spark.read.schema(schema).parquet(_table(out_dir, name, batch_id - 1)) if batch_id
            else spark.createDataFrame([], schema)
            for name, schema in (("totals", TOTALS_SCHEMA), ("queues", QUEUE_SCHEMA))
        }
        words = log_words(batch.where(F.col("user_id").isNotNull())).select("user_id", "seq", "pos", "word")
        new = words.groupBy("user_id", "word").agg(F.count(F.lit(1)).alias("n"))
        totals = before["totals"].unionByName(new).groupBy("user_id", "word").agg(F.sum("n").alias("n"))
        totals.write.mode("overwrite").parquet(_table(out_dir, "totals", batch_id))
        queues = advance_queues(words, before["queues"], k)
        queues.write.mode("overwrite").parquet(_table(out_dir, "queues", batch_id))

    return fold


def start_history_stream(spark: SparkSession, source_dir: str, out_dir: str, checkpoint_dir: str,
                         files_per_trigger: int = 1, available_now: bool = True, k: int = RECENT_WORDS) -> StreamingQuery:
    """Start the stream; its tables are under ``out_dir``, a folder per batch."""
    log = spark.readStream.schema(LOG_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(source_dir)
    w = log.writeStream.foreachBatch(_fold_batch(out_dir, k)).option("checkpointLocation", checkpoint_dir)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def current_view(spark: SparkSession, out_dir: str, name: str, batch: int) -> DataFrame:
    """The state after a batch (``query.lastProgress.batchId``): ``totals`` as (user, word, n), ``recent`` as
    (user, rank, word)."""
    if name == "totals":
        return spark.read.schema(TOTALS_SCHEMA).parquet(_table(out_dir, "totals", batch))
    return queue_ranks(spark.read.schema(QUEUE_SCHEMA).parquet(_table(out_dir, "queues", batch)))
