import random

import pytest
from pyspark.sql import functions as F

from fiscalmill.operators.lookup import Lookup, hot_keys, hot_keys_if_any, left_lookup, salted, salted_join
from tests.conftest import rows


@pytest.fixture(scope="module")
def left(spark):
    """A third of all rows under one key, another part under null."""
    rng = random.Random(7)
    data = []
    for i in range(3000):
        draw = rng.random()
        key = "hot" if draw < 0.34 else None if draw < 0.5 else f"k{rng.randrange(300)}"
        data.append((i, key))
    return spark.createDataFrame(data, "id long, key string")


@pytest.fixture(scope="module")
def right(spark):
    data = [("hot", 1), ("hot", 2), (None, 9)] + [(f"k{i}", i) for i in range(0, 300, 2)]
    return spark.createDataFrame(data, "key string, value int")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(left, right, how):
    plain = left.join(right, "key", how)
    assert rows(salted_join(left, right, ["key"], ["id"], hot_rows=50, how=how)) == rows(plain)
    assert rows(salted_join(left, right, ["key"], ["id"], how=how, left_rows=3000)) == rows(plain)


def test_hot_keys_are_split(left):
    assert {r["key"] for r in hot_keys(left, ["key"], 100).collect()} == {"hot", None}
    split, _ = salted(left, ["key"], ["id"], hot_rows=100)
    largest = split.groupBy("key", "_salt").count().agg(F.max("count")).first()[0]
    assert largest < 200
    assert split.count() == left.count()


def test_broadcast_and_salted_paths_agree(left, right):
    guard = F.col("id") % 3 != 0
    small = Lookup(right)
    large = Lookup(right, broadcast_rows=0, hot_rows=50)
    assert small.small and not large.small
    args = ({"key": F.col("key")}, {"found": "value"}, ["id"], guard)
    first, second = left_lookup(left, small, *args), left_lookup(left, large, *args)
    assert rows(first) == rows(second)
    assert first.where(~guard & F.col("found").isNotNull()).count() == 0
    assert first.select("id").distinct().count() == left.count()


def test_large_lookup_is_not_broadcast(left, right, spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = left_lookup(left, Lookup(right, broadcast_rows=10), {"key": F.col("key")}, {"v": "value"}, ["id"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_staged_lookup_knows_its_size(right):
    assert Lookup(right).staged("right").known_rows == right.count()


def test_keys_are_counted_only_in_crowded_buckets(left):
    found = {r["key"]: r["_parts"] for r in hot_keys_if_any(left, ["key"], 100).collect()}
    assert found == {r["key"]: r["_parts"] for r in hot_keys(left, ["key"], 100).collect()}
    assert hot_keys_if_any(left, ["key"], 3000) is None
    split, hot = salted(left, ["key"], ["id"], hot_rows=3000 - 1)
    assert hot is None and split.where("_salt <> 0").isEmpty()


def test_rows_with_a_null_key_are_not_shuffled(left, right):
    large = Lookup(right, broadcast_rows=0, hot_rows=50)
    args = ({"key": F.col("key")}, {"found": "value"}, ["id"])
    apart = left_lookup(left, large, *args, nulls_apart=True)
    assert apart.columns == left_lookup(left, large, *args).columns
    assert rows(apart) == rows(left_lookup(left, large, *args))
    assert "Union" in apart._jdf.queryExecution().optimizedPlan().toString()
