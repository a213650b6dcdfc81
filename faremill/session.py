"""Session defaults. Everything here is a plain Spark setting; callers may override any of it."""

from __future__ import annotations

import math
import os
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    # zone-less source timestamps are TIMESTAMP_NTZ; UTC keeps any implicit zone cast neutral
    "spark.sql.session.timeZone": "UTC",
    # arithmetic overflow raises instead of wrapping (sums are exact BIGINT fixed point)
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rebalanced writes aim at this much shuffle data per output file
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


SHUFFLED_PER_STORED = 4  # shuffled rows against compressed columnar files, roughly
UNKNOWN_BYTES = 1 << 50  # sources without statistics report far more
_PARTITIONS = "spark.sql.shuffle.partitions"


def shuffle_partitions(shuffled_bytes: int, target_bytes: int = 256 << 20) -> int:
    """Initial shuffle partition count for a job that shuffles about ``shuffled_bytes``.

    AQE can merge partitions but only splits skewed ones, so the initial count must already be
    large enough for one partition to fit an executor core's memory share."""
    return max(8, math.ceil(shuffled_bytes / target_bytes))


def estimated_bytes(df) -> int | None:
    """Bytes that the tables below a frame hold by Spark's statistics, that is by file sizes; None
    where one of them has none. (A join's own estimate is a product, far too much.)"""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return size if size < UNKNOWN_BYTES else None


def task_bytes(df, most: int, least: int = 4 << 20) -> int:
    """Shuffle bytes per write task: ``most``, or for small jobs an even share of the session's
    cores, so that a small window is not left to one of them. Jobs of more than cores x most are
    written as before."""
    size = estimated_bytes(df)
    if size is None:
        return most
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    return min(most, max(least, size // cores))


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Sets a session option for the jobs of a block."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def small_scans(spark: SparkSession, most: int = 8 << 20):
    """Lowers (never raises) the file bytes that a task reads, so that it can sort what it has read
    in memory; rows take ten times the room of columnar files, raw text about 25 times."""
    key = "spark.sql.files.maxPartitionBytes"
    now = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return setting(spark, key, str(min(most, now)))


def sized_shuffles(spark: SparkSession, stored_bytes: int):
    """Raises (never lowers) the shuffle partition count for jobs over ``stored_bytes`` of files."""
    wanted = shuffle_partitions(stored_bytes * SHUFFLED_PER_STORED)
    return setting(spark, _PARTITIONS, str(max(wanted, int(spark.conf.get(_PARTITIONS)))))


def build_spark(app: str, master: str | None = None, shuffled_bytes: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    master = master or os.environ.get("SPARK_MASTER")
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffled_bytes is not None:
        settings[_PARTITIONS] = str(shuffle_partitions(shuffled_bytes))
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
