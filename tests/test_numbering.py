from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fiscalmill.operators.items import item_sums
from fiscalmill.operators.numbering import next_counter, number_rows, seed_counter


def test_numbers_equal_a_global_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 1000).alias("n"), F.col("id").alias("tie")).repartition(7)
    order = [F.col("n").asc_nulls_first(), F.col("tie").asc()]
    mine = number_rows(df, order, 100, "no")
    both = mine.withColumn("want", F.row_number().over(Window.orderBy("n", "tie")) + 100)
    assert both.count() == 5000
    assert both.where("no <> want").count() == 0


def test_one_frequent_value_is_still_dense(spark):
    df = spark.range(0, 3000).select(F.when(F.col("id") < 2000, 5).otherwise(F.col("id")).alias("n"), "id")
    out = number_rows(df, [F.col("n").asc(), F.col("id").asc()], 0, "no")
    stats = out.agg(F.min("no"), F.max("no"), F.count_distinct("no")).first()
    assert tuple(stats) == (1, 3000, 3000)


def test_nulls_come_first(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "n int")
    out = {r["n"]: r["no"] for r in number_rows(df, [F.col("n").asc_nulls_first()], 10, "no").collect()}
    assert out == {None: 11, 1: 12, 2: 13}


def test_counter_survives_an_empty_run(spark):
    empty = spark.createDataFrame([], "NUM_CONTROLE_DOCTO long")
    assert next_counter(empty, 41).first()[0] == 41
    assert seed_counter(empty).first()[0] == 0
    assert next_counter(spark.createDataFrame([(43,)], "NUM_CONTROLE_DOCTO long"), 41).first()[0] == 43


def test_sums_by_series_keep_documents_apart(spark):
    """Two documents of one partner with one number: their sums mix without the series, and do not with it."""
    data = [("E", "B", "000000007", "1", "M1", "1", "3", 10), ("E", "B", "000000007", "2", "M1", "1", "2", 5)]
    kinds = "COD_EMPRESA string, COD_ESTAB string, NUM_DOCFIS string, SERIE_DOCFIS string, COD_FIS_JUR string, IND_FIS_JUR string, TRIB_ICMS string, _base_amount int"
    items = spark.createDataFrame(data, kinds)
    assert [int(r["BASE_IPI"]) for r in item_sums(items).collect()] == [15]
    assert {r["SERIE_DOCFIS"]: int(r["BASE_IPI"]) for r in item_sums(items, by_series=True).collect()} == {"1": 10, "2": 5}
