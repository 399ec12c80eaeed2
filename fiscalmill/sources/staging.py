"""Intermediate tables in the shared folder that the session names as its checkpoint directory."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


COMPRESSION = "zstd"
"""Of intermediate tables. They are written once and read a few times, so their size counts more than the packing."""


def shared_folder(spark: SparkSession) -> str:
    """Checkpoint folder of the session; a temporary one only for local runs that name none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="fiscalmill-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_run_folders: list[str] = []
"""Folder of the run in progress, the innermost last. All sessions and threads of the driver stage there."""


def new_folder(spark: SparkSession, name: str) -> str:
    base = _run_folders[-1] if _run_folders else f"{shared_folder(spark)}/fiscalmill"
    return f"{base}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path for it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = file_system(spark, path)
    return files.exists(at)


def bytes_of(spark: SparkSession, path: str) -> int:
    """Size of a file or a folder, zero if it is not there."""
    files, at = file_system(spark, path)
    return files.getContentSummary(at).getLength() if files.exists(at) else 0


def remove(spark: SparkSession, path: str) -> None:
    """A folder and all in it, on whatever file system the path names; nothing if it is not there."""
    files, at = file_system(spark, path)
    files.delete(at, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
"""Whether Spark removes the shuffle files of a query when it ends, instead of when the driver collects its plan."""


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as parquet and read it back.

    Cuts the lineage, fixes values that would differ on recomputation, survives lost executors, and lets each
    later reader take only the columns it needs. The shuffle files of the write are removed with its end.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    # Only for this write: a frame of the caller's may be run twice on the same shuffle files.
    spark.conf.set(SHUFFLE_CLEANUP, True)
    try:
        df.write.option("compression", COMPRESSION).parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, spark.sparkContext.getConf().get(SHUFFLE_CLEANUP, "false"))
    return spark.read.schema(df.schema).parquet(path)


def stage_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """`stage` together with the number of rows written, observed during the write."""
    seen = Observation()
    staged = stage(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return staged, seen.get["rows"]


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Staging under a folder of its own, which the caller removes when nothing reads from it any more."""
    folder = new_folder(spark, "scratch")
    _run_folders.append(folder)
    try:
        yield folder
    finally:
        _run_folders.remove(folder)


@dataclass(frozen=True)
class Steps:
    """Named intermediate tables of one run. A step that was written to its end is read instead of made again."""

    spark: SparkSession
    folder: str

    def __call__(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        path = f"{self.folder}/step-{name}"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            make().write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
        return self.spark.read.parquet(path)


def fresh(name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A step outside of any run: always made."""
    return stage(make(), name)


@contextmanager
def run_scope(spark: SparkSession, run_id: str) -> Iterator[Steps]:
    """Staging under a folder of the run. The folder goes when the run ends well, and stays for the next try if not."""
    folder = f"{shared_folder(spark)}/fiscalmill/run-{run_id}"
    _run_folders.append(folder)
    try:
        yield Steps(spark, folder)
        remove(spark, folder)
    finally:
        _run_folders.remove(folder)
