"""Dense numbering of a whole table without bringing it into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.sources.staging import stage

ROW_BITS = 33
"""monotonically_increasing_id keeps the partition above this bit and the row below it."""


def number_rows(df: DataFrame, order: list[Column], start: int | Column, name: str) -> DataFrame:
    """Adds `name`: start + 1, start + 2, ... in the given order.

    Range-partitions and sorts, writes the result once with a per-partition row id, then adds the number of rows
    in earlier partitions. Only that list, one row per partition, is brought together. `order` should end in
    columns that make rows distinct, so that a frequent value spreads over several ranges.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stage(placed.withColumn("_row_id", F.monotonically_increasing_id()), "numbering")
    part = F.shiftright("_row_id", ROW_BITS)
    counts = rows.select(part.alias("_part")).groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    row = F.col("_row_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    first = F.lit(start) if isinstance(start, int) else start
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, (first + F.col("_offset") + row + 1).cast("bigint"))
        .drop("_part", "_row_id", "_offset")
    )


def next_counter(headers: DataFrame, previous: int | Column, number: str = "NUM_CONTROLE_DOCTO") -> DataFrame:
    """Highest number in use after a run; an empty run keeps the previous value."""
    kept = F.lit(previous) if isinstance(previous, int) else previous
    return headers.agg(F.coalesce(F.max(number), kept).cast("bigint").alias("NUM_DOCTO"))


def seed_counter(published: DataFrame, number: str = "NUM_CONTROLE_DOCTO") -> DataFrame:
    """Counter from published headers, zero when there are none."""
    return next_counter(published, 0, number)
