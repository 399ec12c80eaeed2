"""The stored parameter table: a folder for each parameter group, replaced group by group."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalmill.operators.numbering import number_rows
from fiscalmill.settings import Settings
from fiscalmill.sources import staging

GROUP, ROW_ID = "ID_PARAMETRO", "ID_PARAM_DET"
COLUMNS = "ID_PARAM_DET long, ID_PARAMETRO long, NOME_PARAM string, CONTEUDO string, DESCRICAO string, VALOR string"
NO_GROUP = -1
"""Folder of the rows without a group; the table has null for it."""

LONGEST_DESCRIPTION = 300


def _write(rows: DataFrame, path: str) -> None:
    """Only the folders of groups that `rows` has are replaced, all when the write commits."""
    grouped = rows.withColumn(GROUP, F.coalesce(GROUP, F.lit(NO_GROUP)))
    grouped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(GROUP).parquet(path)


def store(details: DataFrame, path: str) -> None:
    """Details as the stored table."""
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    kinds = [c.split()[1] for c in COLUMNS.split(", ")]
    _write(details.select(*[F.col(n).cast(k) for n, k in zip(names, kinds, strict=True)]), path)


def read(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(COLUMNS).parquet(path)
    return rows.withColumn(GROUP, F.nullif(F.col(GROUP), F.lit(NO_GROUP)))


def replace(spark: SparkSession, path: str, heads: DataFrame, mapping: DataFrame, settings: Settings) -> None:
    """The rows of the configured group replaced by a mapping (NOME_PARAM, CONTEUDO, DESCRICAO, VALOR).

    The folders of other groups are not touched. Row ids follow the highest id of the other groups in the order of the
    rows, so loading the same mapping again gives the same rows. An empty mapping empties the group.
    """
    group = heads.where(F.col("NOME_FRAMEWORK") == settings.param_framework).agg(F.min("ID_PARAMETROS")).first()[0]
    if group is None:
        raise ValueError(f"no parameter group is named {settings.param_framework}")
    others = read(spark, path).where(F.col(GROUP).isNull() | (F.col(GROUP) != group))
    last = others.agg(F.coalesce(F.max(ROW_ID), F.lit(0)).cast("long")).first()[0]
    named = mapping.select("NOME_PARAM", "CONTEUDO", F.substring("DESCRICAO", 1, LONGEST_DESCRIPTION).alias("DESCRICAO"), "VALOR")
    order = [F.col(c).asc_nulls_first() for c in named.columns]
    fresh = number_rows(named, order, last, ROW_ID).withColumn(GROUP, F.lit(group).cast("long"))
    if fresh.isEmpty():
        staging.remove(spark, f"{path}/{GROUP}={group}")
    else:
        _write(fresh, path)
