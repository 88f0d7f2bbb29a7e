"""Spark session helpers: local builder for tests/bench and the checkpoint folder.

On a cluster the session comes from the caller; nothing here overrides its
settings. ``ensure_checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
session and only falls back to a scratch folder when it is unset (local tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings that matter for every job in the library. They are applied only
# when building a local session; a cluster session keeps its own values.
LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    # Several steps expand small shuffled inputs into heavy CPU work (deletion
    # variants, tokenising, regex matching); do not merge them into one task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.sql.files.maxPartitionBytes": "64m",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "webloom") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session conf.

    Order: an already configured SparkContext folder, then ``spark.checkpoint.dir``
    from the session; only when both are unset (local runs, tests) a scratch
    folder under the system temp dir is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^]]*\])?", sc.master):
            # Only in local mode do driver and executors share this machine's folders.
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object store) for cluster runs")
        configured = tempfile.mkdtemp(prefix="webloom-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (written to the shared checkpoint folder).

    Used where a plan is iterated (PageRank sweeps, crawl levels) or where
    non-deterministic columns (partition ids) must be fixed once. Survives
    executor loss because the data lives in the checkpoint folder, not in
    executor memory.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # Persist first so the eager checkpoint computes the data once (the count
    # and the checkpoint write would otherwise each evaluate the plan).
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = df.checkpoint(eager=True)
    df.unpersist(blocking=False)
    return out


def write_table(df: DataFrame, *partition_by: str) -> str:
    """Write ``df`` as a Parquet table in the shared checkpoint folder (in folders by ``partition_by``, if given)
    and return its path."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/webloom-tables/{uuid.uuid4().hex}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back.

    One job, columnar and compressed; later reads prune columns. Used where
    the physical partitioning does not have to survive (it is re-planned
    from the files).
    """
    return df.sparkSession.read.parquet(write_table(df))


def bucketed(df: DataFrame, num_buckets: int, *cols: str, names: list[str] | None = None, order: str | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed by ``cols`` (in the shared checkpoint folder) and read it back, the rows of a
    bucket in ``order`` if given.

    A bucketed scan reports its hash partitioning, so later joins and
    aggregations on ``cols`` with ``num_buckets`` partitions do not move this
    side. (A checkpointed DataFrame does not keep its partitioning.) The table's name
    is added to ``names``, for who wants to unregister it.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    name = f"webloom_{uuid.uuid4().hex}"
    if names is not None:
        names.append(name)
    writer = df.repartition(num_buckets, *cols).write.bucketBy(num_buckets, *cols)
    writer = writer.sortBy(order) if order else writer
    writer.mode("overwrite").option("path", f"{base}/webloom-tables/{name}").saveAsTable(name)
    return spark.table(name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def target_partitions(df: DataFrame, bytes_per_partition: int = 128 << 20) -> int:
    """Partition count for an explicit repartition of ``df``: about 128 MB each by the
    optimizer's size estimate, at least the default parallelism, at most the shuffle
    partition count (no job is run to estimate)."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    upper = max(shuffle_partitions(spark), cores)
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # estimate unavailable: use the configured count
        return upper
    return max(cores, min(upper, -(-size // bytes_per_partition)))
