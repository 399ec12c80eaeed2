"""What several operators share: tables, words, native let-bindings."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
"""Separators of words in every contract: space and the five control characters from tab to carriage return."""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words of a text; null counts as empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once, also where `body` uses it inside other lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further columns of the input cannot clash with an operator's own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have yet, without regard to case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query whose session sends this library's modules to its executors, once, wherever the driver was started."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        context = spark.sparkContext
        if not getattr(context, "_fiscalmill_shipped", False):
            package = Path(__file__).parents[1]
            archive = Path(tempfile.mkdtemp(prefix="fiscalmill-code-")) / "fiscalmill_code.zip"
            with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
                for file in sorted(package.rglob("*.py")):
                    z.write(file, file.relative_to(package.parent))
            context.addPyFile(str(archive))
            context._fiscalmill_shipped = True
        return query(spark, sf_dir)

    return run
