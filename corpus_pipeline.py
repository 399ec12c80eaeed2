"""The training-data pipeline: quality rules, near duplicates, repeated passages, source mix, token ids.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet before the next one reads it.
All stages but the last return the columns of `documents`. Each works on everything that the one before it kept.
A stage first removes the intermediate tables of the stages before it, unless its own documents are still read from them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from fiscalmill.llm import mixing, near_dedup, pieces, quality_rules, suffix_index
from fiscalmill.sources.staging import remove, scratch, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []
"""Folders with intermediate tables of earlier stages."""


def remove_left(spark: SparkSession, docs: DataFrame) -> None:
    """Intermediate tables of earlier stages go, but for those that `docs` is read from."""
    read = docs.inputFiles() if _left else []
    for folder in [f for f in _left if not any(f in path for path in read)]:
        remove(spark, folder)
        _left.remove(folder)


def tidy(function: Stage) -> Stage:
    """A stage whose intermediate tables go when the next one starts: its result is written by then."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        remove_left(spark, docs)
        with scratch(spark) as folder:
            _left.append(folder)
            return function(spark, docs, sf_dir)

    return run_stage



@tidy
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep(docs)


@tidy
def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: shingles of five words, similarity of 0.8 or more."""
    return near_dedup.one_of_each_group(docs, near_dedup.Likeness())


@tidy
def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The texts without passages of 200 bytes that also start elsewhere."""
    return suffix_index.remove_repeats(docs)


@tidy
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the target mix reads them; a document that is read twice is there twice."""
    return mixing.mix(docs, mixing.PIPELINE)


@tidy
def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and sampled segmentations of every document."""
    return pieces.segmentations(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("suffix_dedup", suffix_stage),
    ("mix_sources", mixing_stage),
    ("sentence_pieces", pieces_stage),
]

ORACLE_SQL = None
"""Similarity groups and sampled segmentations are not expressible in SQL; tests compare with brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    remove_left(spark, docs)
    return docs
