"""Session settings and input spreading that suit wide rows."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession

JIT_METHOD_LIMIT = 8000
"""Largest method, in bytecode, that the JVM compiles. A generated stage above it would run interpreted."""


ADVISED = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

TASK_BYTES = 16 << 20
"""Packed rows of a shuffle or of files that Spark may join into one task, unless the session was started with a number of its own."""

INPUT_BYTES = 4 << 20
"""Packed input for each shuffle partition. Sorts of the documents' lines then stay in memory, about 100 MB a task."""


PARTITIONS = "spark.sql.shuffle.partitions"
RAISED = "fiscalmill.shuffle.raised"
"""Holds "to:from" while `PARTITIONS` stands at a number that `tune` put there."""

SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
JOINED = ["spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled"]


def _named_partitions(spark: SparkSession) -> int:
    """The session's own number of shuffle partitions."""
    now = spark.conf.get(PARTITIONS)
    to, _, own = spark.conf.get(RAISED, "").partition(":")
    return int(own if to == now else now)


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Let stages of very wide rows fall back to per-operator code, which the JVM compiles.

    Shuffles start with partitions in proportion to the input, at least as many as the session names. A fixed number would
    let the tasks grow with the input until their sorts spill. Spark joins small partitions again when it runs; in a session
    where it may not, it also passes over a number to start with, so the session's own number is raised. Where the size of
    the input is not known the number stays as it is. Scans take packed rows in the same portions as shuffles, so that sums
    made while reading stay in memory, too.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", JIT_METHOD_LIMIT)
    for limit in (ADVISED, SPLIT_BYTES):
        if not spark.sparkContext.getConf().contains(limit):
            spark.conf.set(limit, TASK_BYTES)
    if input_bytes is None:
        return spark
    named = _named_partitions(spark)
    wanted = max(named, ceil(input_bytes / INPUT_BYTES))
    joined = all(spark.conf.get(c) == "true" for c in JOINED)
    spark.conf.set(PARTITIONS, named if joined else wanted)
    spark.conf.set(RAISED, f"{wanted}:{named}" if wanted > named and not joined else "")
    if wanted > named and joined:
        spark.conf.set(INITIAL_PARTITIONS, wanted)
    else:
        spark.conf.unset(INITIAL_PARTITIONS)
    return spark


def over_all_cores(scan: DataFrame) -> DataFrame:
    """A file scan over at least as many tasks as there are cores.

    Documents cost much more to build or parse than to move. Inputs with enough splits are left alone.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
