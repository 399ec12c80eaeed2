"""Connected components of large graphs by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from fiscalmill.sources.staging import stage


def _marked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """The edges written to the shared folder, with a mark of their set that is taken while they are written."""
    seen = Observation()
    mark = [F.count(F.lit(1)).alias("n"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("x")]
    staged = stage(edges.observe(seen, *mark), "edges")
    return staged, (seen.get["n"], seen.get["x"])


def components(edges: DataFrame) -> DataFrame:
    """From edges (a, b) the table (id, root) of every vertex but the roots; a root is its component's smallest vertex.

    Every round joins vertices to the smallest vertex they know and writes the edges to the shared folder; paths shrink
    by more than half a round. A vertex with very many neighbours is a minimum (summed per task first) and an equi-join.
    """
    larger = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    current, mark = _marked(larger)
    while True:
        both = current.select(F.col("u").alias("x"), F.col("v").alias("y")).union(current.select("v", "u"))
        lowest = both.groupBy("x").agg(F.min("y").alias("low")).select(F.col("x").alias("of"), F.least("x", "low").alias("low"))
        large = both.join(lowest, F.col("x") == F.col("of")).where("y > x").select(F.col("y").alias("u"), F.col("low").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("low")).withColumnRenamed("u", "of")
        small = large.join(low, F.col("u") == F.col("of"))
        pairs = small.select(F.col("v").alias("u"), F.col("low").alias("v")).union(small.select("u", "low")).where("u <> v")
        following, next_mark = _marked(pairs.distinct())
        if next_mark == mark:
            return current.select(F.col("u").alias("id"), F.col("v").alias("root"))
        current, mark = following, next_mark
