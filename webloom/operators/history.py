"""Search-log analytics (H1-H5) over a log ``(user_id, seq, text)``.

H1 counts words per search string; H2 totals them per user; H3 keeps each
user's 20 most frequent words (count descending, then first use); H4 keeps
each user's 10 most recent distinct words with the reference's queue rule
(a word is appended only if it is not in the queue; the oldest drops out at
10; no move to the end on repeat); H5 is H2 + H4 cut at a sign-out turn.

H4 is an order-dependent fold, evaluated in bounded chunks of a user's words with one JVM ``aggregate`` each: all
chunks at once, then again where a chunk began from another queue than its predecessor ended with. No user's
history is ever one group, one task's work or one array, however long it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webloom.functions.text import normalize_query, split_query_words
from webloom.operators.distribute import row_numbers
from webloom.session import materialize, target_partitions

TOP_WORDS = 20  # fixed value: history table size
RECENT_WORDS = 10  # fixed value: recent-words queue length


def log_words(log: DataFrame) -> DataFrame:
    """Normalised words of each search string: ``(user_id, seq, pos, word)``."""
    return log.select(
        "user_id", "seq", F.posexplode(split_query_words(normalize_query(F.col("text")))).alias("pos", "word")
    ).select("user_id", "seq", F.col("pos").cast("int").alias("pos"), "word")


def query_word_counts(log: DataFrame) -> DataFrame:
    """H1: ``(user_id, seq, word, n, first_pos)`` — counts within one search string."""
    return log_words(log).groupBy("user_id", "seq", "word").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.min("pos").alias("first_pos")
    )


def history_counts(log: DataFrame) -> DataFrame:
    """H2: ``(user_id, word, n, first_seq, first_pos)`` for signed-in users (non-null id)."""
    w = log_words(log.where(F.col("user_id").isNotNull()))
    return w.groupBy("user_id", "word").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"),
        F.min(F.struct("seq", "pos")).alias("first"),
    ).select("user_id", "word", "n", F.col("first.seq").alias("first_seq"), F.col("first.pos").alias("first_pos"))


def history_top(log: DataFrame, k: int = TOP_WORDS) -> DataFrame:
    """H3: ``(user_id, rank, word, n)``; count descending, ties in order of first use.

    Ranking uses ``row_numbers`` (range partitions), so a user with millions
    of distinct words is spread over tasks.
    """
    counts = history_counts(log)
    ranked = row_numbers(
        counts,
        order_by=[F.col("n").desc(), F.col("first_seq"), F.col("first_pos"), F.col("word")],
        partition_by=["user_id"],
        out="rank",
    )
    return ranked.where(F.col("rank") <= k).select("user_id", "rank", "word", "n")


RECENT_CHUNK_ROWS = 100_000  # words of one user's history folded at a time
QUEUE_SCHEMA = "user_id long, queue array<string>"


def queue_after(queue: Column, words: Column, k: int = RECENT_WORDS) -> Column:
    """The queue (oldest first) after searching ``words`` in order: unknown words enter at the end, and all but
    the last ``k`` leave; known words stay where they are."""
    enter = lambda q, w: F.when(F.array_contains(q, w), q).otherwise(
        F.slice(F.array_append(q, w), F.greatest(F.size(q) + 2 - k, F.lit(1)), k))
    return F.aggregate(words, queue, enter)


def advance_queues(words: DataFrame, before: DataFrame, k: int = RECENT_WORDS,
                   chunk_rows: int = RECENT_CHUNK_ROWS) -> DataFrame:
    """Queues ``(user_id, queue)`` after the words ``(user_id, seq, pos, word)``, starting from ``before``.

    Words are numbered per user in (seq, pos) order with ``row_numbers`` (a user with a third of the log spans
    many range partitions) and put together in chunks of ``chunk_rows``. All chunks are folded at once, a user's first
    one from the queue carried in, the others as if the queue were empty. Then each chunk whose predecessor ended
    with another queue than it started from is folded again, until none is left. Queues forget how they began
    within some words, so one such repair is the rule, however many chunks a user has; the result is exact in any
    case. Users without a word keep their queue.
    """
    numbered = row_numbers(words, order_by=["seq", "pos"], partition_by=["user_id"], out="rn")
    chunk = F.floor((F.col("rn") - 1) / F.lit(chunk_rows)).cast("long")
    chunks = materialize(numbered.groupBy("user_id", chunk.alias("chunk")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rn", "word"))), lambda x: x["word"]).alias("words")))
    nothing = F.array().cast("array<string>")
    carried = before.select("user_id", F.col("queue").alias("carried"), F.lit(0).cast("long").alias("chunk"))
    started = chunks.join(carried, ["user_id", "chunk"], "left").withColumn("start", F.coalesce("carried", nothing))
    folded = materialize(started.select("user_id", "chunk", "start", queue_after(F.col("start"), F.col("words"), k).alias("end")))
    while True:
        ends = folded.select("user_id", (F.col("chunk") + 1).alias("chunk"), F.col("end").alias("given"))
        wrong = materialize(folded.join(ends, ["user_id", "chunk"]).where("start <> given").select("user_id", "chunk", "given"))
        if wrong.isEmpty():
            break
        again = chunks.join(wrong, ["user_id", "chunk"]).select(
            "user_id", "chunk", F.col("given").alias("start"), queue_after(F.col("given"), F.col("words"), k).alias("end"))
        folded = materialize(folded.join(wrong, ["user_id", "chunk"], "left_anti").unionByName(again))
    last = folded.groupBy("user_id").agg(F.max_by("end", "chunk").alias("end"))
    return before.join(last, "user_id", "full_outer").select("user_id", F.coalesce("end", "queue").alias("queue"))


def queue_ranks(queues: DataFrame) -> DataFrame:
    """``(user_id, rank, word)``, rank 1 = newest."""
    return queues.select("user_id", F.posexplode(F.reverse("queue")).alias("r", "word")).select(
        "user_id", (F.col("r") + 1).cast("int").alias("rank"), "word")


def recent_words(log: DataFrame, k: int = RECENT_WORDS, chunk_rows: int = RECENT_CHUNK_ROWS) -> DataFrame:
    """H4: ``(user_id, rank, word)`` of the user's last ``k`` queued words, rank 1 = newest."""
    words = log_words(log.where(F.col("user_id").isNotNull())).select("user_id", "seq", "pos", "word")
    none = log.sparkSession.createDataFrame([], QUEUE_SCHEMA)
    return queue_ranks(advance_queues(words, none, k, chunk_rows))


def _next_mark(rows: DataFrame) -> DataFrame:
    """``rows`` with ``signout_seq``: the seq of the user's next row with ``out = 1`` in (seq, out) order.

    Rows lie in range partitions of (user_id, seq, out), so a user with most of the log has many of them. What a
    partition does not know comes from the first mark in the user's later partitions.
    """
    keys = ["user_id", "seq", "out"]
    # Partition numbers are fixed in a written table before they are used twice.
    placed = materialize(rows.repartitionByRange(target_partitions(rows), *keys).withColumn("_p", F.spark_partition_id()))
    mark = F.min(F.when(F.col("out") == 1, F.col("seq")))
    ahead = Window.partitionBy("_p", "user_id").orderBy("seq", "out").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # A row per user and partition, of users in several partitions at most one per partition.
    first = placed.groupBy("_p", "user_id").agg(mark.alias("first"))
    later = Window.partitionBy("user_id").orderBy("_p").rowsBetween(1, Window.unboundedFollowing)
    after = first.select("_p", "user_id", F.min("first").over(later).alias("after"))
    here = placed.withColumn("here", mark.over(ahead)).join(after, ["_p", "user_id"])
    return here.withColumn("signout_seq", F.coalesce("here", "after")).drop("_p", "here", "after")


def history_snapshot(log: DataFrame, signouts: DataFrame) -> DataFrame:
    """H5: per user, the word totals and the recent queue as of the user's sign-out, after which both start anew.

    ``signouts``: ``(user_id, seq)``, a row per sign-out. Returns ``(user_id, signout_seq, word, n,
    recent_rank)`` for the searches after the sign-out before; ``recent_rank`` is NULL for words no longer in
    the queue. Searches after a user's last sign-out, and of users who never sign out, are in no snapshot.
    """
    mark = signouts.select("user_id", "seq", F.lit(None).cast("string").alias("text"), F.lit(1).alias("out"))
    rows = log.select("user_id", "seq", "text", F.lit(0).alias("out")).unionByName(mark).where(F.col("user_id").isNotNull())
    ended = _next_mark(rows).where((F.col("out") == 0) & F.col("signout_seq").isNotNull())
    # Sessions are numbered by one column, as users are elsewhere.
    sessions = materialize(row_numbers(ended.select("user_id", "signout_seq").distinct(), ["user_id", "signout_seq"], out="session"))
    cut = ended.join(sessions, ["user_id", "signout_seq"]).select(F.col("session").alias("user_id"), "seq", "text")
    counts = history_counts(cut).select("user_id", "word", "n")
    recent = recent_words(cut).select("user_id", "word", F.col("rank").alias("recent_rank"))
    both = counts.join(recent, ["user_id", "word"], "left").withColumnRenamed("user_id", "session")
    return both.join(sessions, "session").select("user_id", "signout_seq", "word", "n", "recent_rank")
