"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom import session

#: Setting under which Spark removes a query's shuffle files as soon as the query has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: How the tables written on the way are packed.
CODEC_SETTING, CODEC = "spark.sql.parquet.compression.codec", "zstd"

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Words: maximal runs of anything but the space and the characters U+0009 to U+000D.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Words of 64 bits of the table that tells which hashes may be wanted; it is broadcast and never has more rows.
SIFT_WORDS = 1 << 18


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def count_words(text: Column) -> Column:
    """Number of words (``WORD_PATTERN``) of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def partition_offsets(stats: DataFrame, part: str, amounts: list[str]) -> DataFrame:
    """Running sums before each partition: from ``(part, amounts...)`` to ``(part, <amount>_before...)``.

    ``stats`` has one row per task partition (numbers only), as in Spark's own ``zipWithIndex``; that many
    rows are summed on the driver and sent back.
    """
    spark = stats.sparkSession
    rows = sorted(tuple(r) for r in stats.select(part, *amounts).collect())
    out, sums = [], [0] * len(amounts)
    for r in rows:
        out.append((int(r[0]), *sums))
        sums = [s + int(x) for s, x in zip(sums, r[1:], strict=True)]
    schema = ", ".join([f"{part} int", *(f"{a}_before long" for a in amounts)])
    return spark.createDataFrame(out, schema)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back; its shuffle files go once it is written (else
    they stay until the driver collects its garbage). Tables with texts take most of the disk: they are packed by
    ``CODEC``. The session's settings are left as they were."""
    conf = df.sparkSession.conf
    own = {SHUFFLE_CLEANUP: "true", CODEC_SETTING: CODEC}
    before = {k: conf.get(k, None) for k in own}
    for k, v in own.items():
        conf.set(k, v)
    try:
        return session.materialize(df)
    finally:
        for k, v in before.items():
            if v is None:
                conf.unset(k)
            else:
                conf.set(k, v)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once all that is read from them has been written itself."""
    for table in tables:
        folders = {f.rpartition("/")[0] for f in table.inputFiles()}
        jvm = table.sparkSession._jvm
        for folder in folders:
            if "/webloom-tables/" in folder:
                path = jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def sifted(df: DataFrame, hashed: str, wanted: DataFrame) -> DataFrame:
    """The rows of ``df`` whose 64-bit hash is in ``wanted`` (same column), and few others: a table of ``SIFT_WORDS``
    words holds one bit for each wanted hash. What it lets through by chance, an exact join has to drop."""
    word = F.pmod(F.xxhash64(hashed), F.lit(SIFT_WORDS))
    bit = F.shiftrightunsigned(F.xxhash64(hashed), 48).bitwiseAND(F.lit(63)).cast("int")
    table = wanted.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_mask"))
    marked = df.withColumn("_word", word).withColumn("_bit", bit).join(F.broadcast(table), "_word")
    return marked.where("(shiftrightunsigned(_mask, _bit) & 1L) = 1L").select(*df.columns)


def release_memory() -> None:
    """Hand memory that a finished task has freed back to the system: Spark keeps Python workers for later tasks,
    and their allocators would keep the peak of every task before."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


__all__ = ["ASCII_UPPER", "WORD_PATTERN", "count_words", "discard", "documents", "lower_ascii", "materialize", "partition_offsets", "release_memory", "sifted"]
