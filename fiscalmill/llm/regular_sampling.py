"""Exact ranks of a whole table by parallel sorting by regular sampling.

1. Every task sorts its rows: a run, written with the run's number and the row's place in it.
2. From each of the p runs, p rows at regular places are sampled. The sorted samples, each standing for its share of its
   run, give p - 1 splitters. Keys end in (run, place) and so are all different: however often a score or an id repeats,
   a segment between two splitters holds at most about twice the mean.
3. Every row goes to the segment of its key, and each segment is sorted where it arrives.
4. Segment sizes are summed up to prefix counts; a row's rank is its segment's prefix count and its place there.

Only the samples (p times p at most) and the segment sizes (p rows) come to the driver. p is the session's number of
shuffle partitions, at most MOST_RUNS; larger tables make longer runs, which Spark sorts with spilling.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fiscalmill.sources.staging import stage

MOST_RUNS = 512
ROW_BITS = 33
"""monotonically_increasing_id keeps the partition above this bit and the row below it."""

KEY = ["__score", "__id", "__run", "__place"]


def _order() -> list[Column]:
    return [F.col("__score").desc(), F.col("__id").asc_nulls_last(), F.col("__run").asc(), F.col("__place").asc()]


def _comparable(score: int, name: int | None, run: int, place: int) -> tuple:
    return -score, name is None, name or 0, run, place


def _runs(rows: DataFrame, parts: int) -> DataFrame:
    """The rows sorted within at most `parts` tasks, with their run and their place in it."""
    few = rows if rows.rdd.getNumPartitions() <= parts else rows.coalesce(parts)
    local = few.sortWithinPartitions(F.col("__score").desc(), F.col("__id").asc_nulls_last())
    numbered = local.withColumn("__row", F.monotonically_increasing_id())
    row = F.col("__row").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return stage(numbered.withColumns({"__run": F.shiftright("__row", ROW_BITS), "__place": row}).drop("__row"), "runs")


def splitters(samples: list[tuple], weights: dict[int, float], parts: int) -> list[tuple]:
    """Keys that cut the table into `parts` segments, from sampled keys that each stand for a share of their run."""
    total, seen, cuts = sum(weights[s[3]] for s in samples), 0.0, []
    for s in sorted(samples):
        while len(cuts) < parts - 1 and seen >= total * (len(cuts) + 1) / parts:
            cuts.append(s)
        seen += weights[s[3]]
    return sorted(set(cuts))


def _segments(cuts: list[tuple], names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(*[batch.column(k).to_pylist() for k in KEY], strict=True)
            found = pa.array([bisect_right(cuts, _comparable(*k)) for k in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], found], names=[*names, "__segment"])

    return run


def ranked(rows: DataFrame, score: str, name: str, rank: str) -> tuple[DataFrame, int]:
    """The rows with their rank (1, 2, 3 ...) by falling score, then rising id, null last; and the number of rows.

    Rows that agree in both keep an order of their own. `score` must not be null.
    """
    spark, kept = rows.sparkSession, rows.columns
    parts = max(1, min(MOST_RUNS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    runs = _runs(rows.withColumns({"__score": F.col(score), "__id": F.col(name)}), parts)
    sizes = runs.groupBy("__run").agg(F.count(F.lit(1)).alias("__n"))
    step = lambda place: F.floor(place * F.lit(parts) / F.col("__n"))
    regular = (F.col("__place") == 0) | (step(F.col("__place")) > step(F.col("__place") - 1))
    sampled = runs.select(*KEY).join(F.broadcast(sizes), "__run").where(regular).select(*KEY, "__n").collect()
    share = {}
    for s in sampled:
        share.setdefault(s["__run"], [s["__n"], 0])[1] += 1
    weights = {run: n / samples for run, (n, samples) in share.items()}
    cuts = splitters([_comparable(*[s[k] for k in KEY]) for s in sampled], weights, parts)
    placed = T.StructType([*runs.schema.fields, T.StructField("__segment", T.IntegerType())])
    dealt = runs.mapInArrow(_segments(cuts, runs.columns), placed).repartitionById(parts, F.col("__segment"))
    merged = stage(dealt.sortWithinPartitions(*_order()).withColumn("__at", F.monotonically_increasing_id()), "segments")
    lengths = merged.groupBy("__segment").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("first")).collect()
    before, offsets = 0, []
    for s in sorted(lengths, key=lambda s: s["__segment"]):
        offsets.append((s["__segment"], before - s["first"] + 1))
        before += s["n"]
    shifts = F.broadcast(spark.createDataFrame(offsets, "__segment int, __shift long"))
    return merged.join(shifts, "__segment").select(*kept, (F.col("__at") + F.col("__shift")).alias(rank)), before
