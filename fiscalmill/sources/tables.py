"""Reading master data from a database or from files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    fetch_size: int = 500,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int = 1,
    **options: str,
) -> DataFrame:
    """Result of a database query.

    With a partition column and its bounds the rows arrive in parallel, one range per task; without, one task reads
    them all, which suits short lists only.
    """
    reader = spark.read.format("jdbc").options(url=url, fetchsize=str(fetch_size), **options)
    if partition_column is None:
        return reader.option("query", query).load()
    if bounds is None:
        raise ValueError("a partition column needs bounds")
    # Spark allows ranges only over a table expression.
    return (
        reader.option("dbtable", f"({query}) q")
        .option("partitionColumn", partition_column)
        .option("lowerBound", bounds[0])
        .option("upperBound", bounds[1])
        .option("numPartitions", str(partitions))
        .load()
    )
