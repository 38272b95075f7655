from contextlib import contextmanager
from datetime import date, datetime

import pytest
from helpers import counted, final_plan_of, plan_of, rows_of
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchantry.operators import (
    column_profile,
    following_value,
    latest_per_key,
    left_lookup,
    ordered_blocks,
    roll_up,
    surrogate_key,
    table_profile,
    top_n,
    top_n_per_group,
)
from merchantry.operators.joins import hot_keys
from merchantry.operators.ordering import BLOCK, POSITION
from merchantry.plans.gold import enriched_customers


@contextmanager
def settings(spark, **values):
    names = {name: name.replace("__", ".") for name in values}
    before = {n: spark.conf.get(n, None) for n in names.values()}
    for name, value in values.items():
        spark.conf.set(names[name], value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def many_blocks(spark):
    return settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false")


def no_broadcast(spark):
    return settings(spark, spark__sql__autoBroadcastJoinThreshold="-1")


def skewed(spark, rows=6000):
    """A third of the rows under one key, a sixth of them exact copies, some NULLs."""
    n = F.col("id")
    return spark.range(rows).select(
        F.when(n % 3 == 0, "hot").when(n % 101 == 1, None).otherwise((n % 400).cast("string")).alias("k"),
        F.when(n % 6 == 0, 7).when(n % 103 == 2, None).otherwise(n * 37 % 1000).cast("int").alias("v"),
        F.when(n % 6 == 0, 0).otherwise(n).alias("w"),
    )


def test_surrogate_key_equals_a_window_over_the_whole_table(spark):
    df = skewed(spark)
    with many_blocks(spark):
        found = surrogate_key(df, ["v", "k"], "key").select("key", "k", "v", "w")
        expected = df.select(F.row_number().over(W.orderBy("v", "k", "w")).cast("bigint").alias("key"), "k", "v", "w")
        assert counted(found) == counted(expected)


def test_surrogate_key_is_dense_on_a_table_of_copies(spark):
    df = spark.range(5000).select(F.lit("same").alias("a"))
    with many_blocks(spark):
        blocks = ordered_blocks(df, ["a"])
        sizes = [r["count"] for r in blocks.groupBy(BLOCK).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 1500
        keys = surrogate_key(df, ["a"], "key")
        assert sorted(r.key for r in keys.collect()) == list(range(1, 5001))


def test_surrogate_key_of_nothing(spark):
    assert rows_of(surrogate_key(spark.range(0), ["id"], "key")) == []


def test_ordered_blocks_cut_a_hot_key(spark):
    with many_blocks(spark):
        blocks = ordered_blocks(skewed(spark), ["k"])
        assert blocks.where("k = 'hot'").select(BLOCK).distinct().count() > 1
        largest = blocks.groupBy(BLOCK).agg(F.max(POSITION) + 1).agg(F.max("(max(_position) + 1)"))
        assert largest.first()[0] < 1500


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_following_value_equals_lead(spark, coalesce):
    df = skewed(spark)
    expected = df.withColumn("next", F.lead("v").over(W.partitionBy("k").orderBy("v", "w")))
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled=coalesce):
        assert counted(following_value(df, "k", ["v"], "v", "next")) == counted(expected)


def test_following_value_on_copies_and_single_rows(spark):
    same = spark.range(3000).select(F.lit("a").alias("k"), F.lit(1).alias("v"))
    df = same.union(spark.createDataFrame([("b", 1), ("b", None), ("c", 2)], "k string, v int"))
    with many_blocks(spark):
        found = counted(following_value(df, "k", ["v"], "v", "n").select("k", "v", "n"))
    # Columns by name: k, n, v.
    assert found == {
        ("a", 1, 1): 2999, ("a", None, 1): 1, ("b", 1, None): 1, ("b", None, 1): 1, ("c", None, 2): 1
    }


def test_single_tasks_see_one_row_per_block(spark):
    with many_blocks(spark):
        keyed = plan_of(surrogate_key(skewed(spark), ["v"], "key")).split("Initial Plan")[-1]
        assert keyed.count("Exchange SinglePartition") == 1
        assert "HashAggregate(keys=[_block" in keyed.split("Exchange SinglePartition")[1].split("\n")[1]
        led = plan_of(following_value(skewed(spark), "k", ["v"], "v", "n")).split("Initial Plan")[-1]
        assert led.count("Exchange SinglePartition") == 1
        assert "Filter" in led.split("Exchange SinglePartition")[1]
        assert "= 0)" in led.split("Exchange SinglePartition")[1]


def lookup_pair(spark):
    left = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 40)
        .cast("bigint").alias("lk"),
        F.col("id").alias("lv"),
    )
    right = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 90 == 1, None).otherwise(F.col("id") % 25)
        .cast("bigint").alias("rk"),
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")).alias("rv"),
    )
    return left, right


@pytest.mark.parametrize("modest_group", [1_000_000, 100, 1])
def test_left_lookup_equals_a_left_join(spark, modest_group):
    left, right = lookup_pair(spark)
    expected = counted(left.join(right, left.lk == right.rk, "left"))
    with no_broadcast(spark):
        found = left_lookup(left, right, "lk", "rk", modest_group)
        assert counted(found) == expected
        assert ("_right_slice" in plan_of(found)) == (modest_group < 1_000_000)


def test_left_lookup_with_a_hot_key_the_left_side_lacks(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "lk bigint, lv string")
    right = spark.range(1000).select(F.lit(7).cast("bigint").alias("rk"))
    found = left_lookup(left, right, "lk", "rk", modest_group=10)
    assert sorted(rows_of(found), key=str) == [(1, "a", None), (None, "b", None)]


def test_hot_keys(spark):
    _, right = lookup_pair(spark)
    assert set(hot_keys(right, "rk", 100)) == {7}
    assert hot_keys(right, "rk") == {}
    # The limit is the same however large the table is.
    many = spark.range(60_000).selectExpr("CASE WHEN id < 60 THEN -1 ELSE id END AS rk")
    assert set(hot_keys(many, "rk", 50)) == {-1}
    assert hot_keys(right.where("false"), "rk", 1) == {}
    texts = right.select(F.concat(F.lit("k"), "rk").alias("rk"))
    assert set(hot_keys(texts, "rk", 100)) == {"k7"}


def test_a_hot_key_on_the_left_is_split_by_the_adaptive_join(spark):
    left = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("lk"),
        F.sha2(F.col("id").cast("string"), 256).alias("lv"),
    )
    right = spark.range(5000).select(F.col("id").alias("rk"), F.md5(F.col("id").cast("string")).alias("rv"))
    with no_broadcast(spark), settings(
        spark,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="1MB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="1MB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        df = left_lookup(left.repartition(8), right, "lk", "rk")
        assert "skew=true" in final_plan_of(df)
        assert df.where("rv IS NULL").count() == 0 and df.count() == 300_000


def test_both_lookups_of_a_customer_split_a_hot_key(spark):
    n = F.col("id")
    key = F.when(n % 3 == 0, None).when(n % 3 == 1, "AW7").otherwise(F.concat(F.lit("AW"), n % 5000))
    customers = spark.range(150_000).select(
        n.alias("cst_id"), key.alias("cst_key"), F.sha2(n.cast("string"), 256).alias("cst_firstname")
    )
    ids = spark.range(5000).select(F.concat(F.lit("AW"), n).alias("cid"), n)
    erp = ids.select("cid", F.lit(None).cast("date").alias("bdate"), F.lit("Male").alias("gen"))
    places = ids.select("cid", F.md5(n.cast("string")).alias("cntry"))
    with no_broadcast(spark), settings(
        spark,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="500KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="500KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
    ):
        df = enriched_customers(customers.repartition(8), erp, places)
        assert final_plan_of(df).split("Initial Plan")[0].count("skew=true") == 2
        assert df.count() == 150_000 and df.where("cntry IS NULL").count() == 50_000


def test_latest_per_key_limits_groups_in_the_map_tasks(spark):
    df = skewed(spark)
    latest = latest_per_key(df, "k", "v")
    plan = plan_of(latest)
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2
    expected = df.groupBy("k").agg(F.max("v").alias("v"))
    assert counted(latest.select("k", "v")) == counted(expected)


def test_top_n(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 9), (4, None)], "i int, v int")
    assert rows_of(top_n(df, [F.desc("v"), "i"], 3)) == [(3, 9), (1, 5), (2, 5)]
    assert rows_of(top_n(df, [F.asc("v"), "i"], 2)) == [(4, None), (1, 5)]
    assert "TakeOrderedAndProject" in plan_of(top_n(df, [F.desc("v"), "i"], 3))


def test_top_n_per_group(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 3), ("b", 1), (None, 4)], "g string, v int")
    found = top_n_per_group(df, ["g"], [F.desc("v")], 2, "r")
    assert sorted(rows_of(found), key=str) == [("a", 2, 2), ("a", 3, 1), ("b", 1, 1), (None, 4, 1)]


def test_roll_up_equals_join_then_sum(spark):
    fact = skewed(spark).withColumn("y", F.col("w") % 4)
    dimension = spark.range(0, 500, 2).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 7).alias("colour")
    )
    joined = fact.join(dimension, "k", "left")
    assert counted(roll_up(fact, dimension, "k", ["colour"], {"s": "v"}, by=["y"])) == counted(
        joined.groupBy("y", "colour").agg(F.sum("v").alias("s"))
    )
    met = fact.join(dimension.withColumn("dk", F.col("k")), "k", "left")
    assert counted(roll_up(fact, dimension, "k", ["colour"], {"s": "v"}, members="n")) == counted(
        met.groupBy("colour").agg(F.sum("v").alias("s"), F.count_distinct("dk").alias("n"))
    )


def test_roll_up_shuffles_sums_only(spark):
    fact, dimension = skewed(spark), spark.range(9).select(F.col("id").cast("string").alias("k"))
    with no_broadcast(spark):
        plan = plan_of(roll_up(fact, dimension, "k", [], {"s": "v"}))
    first_exchange = plan.split("Exchange hashpartitioning(k")[-1]
    assert "partial_sum(v" in first_exchange.split("\n")[1]


def test_profiles(spark):
    df = spark.createDataFrame(
        [(1, "b", date(2020, 1, 1), datetime(2020, 1, 1)), (10, None, None, None), (9, "b", None, None)],
        "i int, s string, d date, t timestamp_ntz",
    )
    tables = {"x": df, "empty": df.where("false")}
    assert sorted(rows_of(table_profile(tables))) == [("empty", 0, 4), ("x", 3, 4)]
    found = sorted(rows_of(column_profile({"x": df})))
    assert found == [
        ("x", "d", "date", 1, 1, "2020-01-01", "2020-01-01"),
        ("x", "i", "int", 3, 3, "1", "10"),
        ("x", "s", "string", 2, 1, "b", "b"),
        ("x", "t", "timestamp_ntz", 1, 1, "2020-01-01 00:00:00", "2020-01-01 00:00:00"),
    ]
    empty = sorted(rows_of(column_profile({"e": df.where("false")})))
    assert [r[3:] for r in empty] == [(0, 0, None, None)] * 4


def test_members_per_period_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    with pytest.raises(ValueError, match="once per value"):
        roll_up(df, df, "k", ["v"], {"s": "v"}, by=["v"], members="n")


def test_a_lookup_warns_where_hot_keys_are_not_split(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        with pytest.warns(UserWarning, match="not split"):
            left_lookup(df, df.toDF("a", "b"), "k", "a")
    finally:
        spark.conf.unset("spark.sql.adaptive.skewJoin.enabled")
