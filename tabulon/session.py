"""Session helpers: the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabulon")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    active = context.getCheckpointDir()
    if configured:
        if active is None:
            context.setCheckpointDir(configured)
        return configured
    if active:
        return active
    # local-cluster[...] has executors of their own, which need a shared folder like any cluster.
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tabulon-")
    context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Used where a plan reads the same intermediate several times, or where
    partition boundaries must stay fixed between two reads.
    """
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it again, for the steps of a loop.

    Read from its files a table has its true size and few partitions. A checkpointed plan keeps the estimate of the
    plan it replaces, which multiplies with every join, and the partitions of every union, so both explode in a loop.
    """
    path = scratch_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go as soon as the action that made them ends; for loops over written steps.

    Otherwise they stay until the driver collects garbage, which a loop of small steps may not do before the disk is full.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread(df: DataFrame) -> DataFrame:
    """Use every core for work that is heavy per row.

    Only a table in fewer partitions than there are cores is moved, so a table
    read from many files stays where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def spread_groups(df: DataFrame, key: str, groups: int) -> DataFrame:
    """Hash ``groups`` heavy groups over tasks that stay apart, however few bytes they hold."""
    spark = df.sparkSession
    most = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(max(1, min(groups, most)), key)


def side_by_side(work, items, threads: int = 4) -> list:
    """Run independent jobs at once, so that small ones do not wait for each other."""
    items = list(items)
    with ThreadPool(max(1, min(threads, len(items)))) as pool:
        return pool.map(inheritable_thread_target(work), items)
