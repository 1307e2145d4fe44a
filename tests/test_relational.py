import pytest
from pyspark.sql import functions as F

import duskwatch as dw
from duskwatch.operators.relational import (
    derive_by_category,
    distinct_columns,
    spread_join,
    with_surrogate_ids,
)


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [("a", 1, 10), ("a", 2, 20), ("b", 3, None), (None, 4, 40)], "k string, i int, v int"
    )


def test_select(df):
    assert dw.select_columns(df, "v", "k").columns == ["v", "k"]
    assert dw.select_columns(df, ["k", "k"]).columns == ["k", "k"]


def test_distinct(df, rows):
    assert rows(distinct_columns(df, "k")) == sorted([("a",), ("b",), (None,)], key=repr)


def test_sort_and_nulls(df):
    assert [r.k for r in dw.sort_by_column(df, "k").collect()] == [None, "a", "a", "b"]
    assert [r.k for r in dw.sort_by_column(df, "k", ascending=False).collect()] == ["b", "a", "a", None]


def test_sort_many(df):
    got = dw.sort_by_columns(df, ["k", "i"], ascending=[True, False]).collect()
    assert [(r.k, r.i) for r in got] == [(None, 4), ("a", 2), ("a", 1), ("b", 3)]
    assert [r.i for r in dw.sort_by_columns(df, "i", ascending=False).collect()] == [4, 3, 2, 1]
    with pytest.raises(AssertionError):
        dw.sort_by_columns(df, ["k", "i"], ascending=[True])


def test_join_keeps_one_key_and_drops_null_keys(df, spark, rows):
    other = spark.createDataFrame([("a", "x"), (None, "y")], "k string, w string")
    joined = dw.join_tables(df, other, "k")
    assert joined.columns == ["k", "i", "v", "w"]
    assert rows(joined, "i") == [(1,), (2,)]
    assert dw.join_tables(df, df.withColumn("z", F.lit(0)), ["k", "i"]).count() == 3


def test_aggregate(df, rows):
    out = dw.aggregate_data(df, ["k"], ["i", "v"], [F.min, F.sum], ["lo", "total"])
    assert rows(out) == sorted([("a", 1, 30), ("b", 3, None), (None, 4, 40)], key=repr)
    assert rows(dw.aggregate_data(df, [], ["i"], [F.max], ["hi"])) == [(4,)]
    with pytest.raises(ValueError):
        dw.aggregate_data(df, ["k"], ["i", "v"], [F.min], ["lo"])


def test_derive(df, rows):
    out = derive_by_category(df, "side", "k", ["a"], "in", "out")
    assert rows(out, "i", "side") == [(1, "in"), (2, "in"), (3, "out"), (4, "out")]


def test_surrogate_ids_follow_the_order(df):
    numbered = with_surrogate_ids(df, "id", F.desc("i"), start=100)
    ordered = numbered.orderBy("id").collect()
    assert [r.i for r in ordered] == [4, 3, 2, 1]
    assert ordered[0].id == 100
    assert len({r.id for r in ordered}) == 4


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_a_plain_join(spark, rows, how):
    split = spark.range(500).selectExpr("IF(id % 3 = 0, 0, id % 40) AS k", "id AS u")
    copied = spark.range(20).selectExpr("id % 10 AS k", "id AS w")
    expected = rows(split.join(copied, "k", how))
    for target in (20, 1_000):
        assert rows(spread_join(split, copied, "k", "u", how, target=target)) == expected


def test_ties_of_a_sort_are_cut_apart(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        hot = spark.range(20_000).selectExpr("1 AS k", "id")
        sizes = dw.sort_by_column(hot, "k").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)])
        assert max(sizes.collect()) < 10_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_sort_of_columns_that_cannot_be_hashed(spark):
    df = spark.createDataFrame([(2, {"a": 1}), (1, {"b": 2})], "i int, m map<string,int>")
    assert [r.i for r in dw.sort_by_column(df, "i").collect()] == [1, 2]
    doubled = df.select("i", "i", "m")
    assert dw.sort_by_column(doubled.toDF("i", "j", "m"), "i").count() == 2
