"""Competition rank, running total and row numbers on distributed data."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from orderloom.operators import ranking


def ranked(df):
    got = ranking.rank_descending(df, "v", "r")
    return sorted((r["k"], r["r"]) for r in got.collect())


def expected(df):
    window = Window.orderBy(F.col("v").desc_nulls_last())
    return sorted((r["k"], r["r"]) for r in df.withColumn("r", F.rank().over(window)).collect())


def test_ties_share_a_rank(spark):
    df = spark.createDataFrame([("a", 10), ("b", 10), ("c", 5)], "k string, v int")
    assert ranked(df) == [("a", 1), ("b", 1), ("c", 3)]


VALUES = {
    "distinct": "cast(id as decimal(18,2)) / 7",
    "ties": "cast(id % 13 as decimal(18,2))",
    "a third tied": "cast(if(id % 3 = 0, 500, id) as decimal(18,2))",
    "nulls": "cast(if(id % 5 = 0, null, id % 50) as decimal(18,2))",
    "one value": "cast(1 as decimal(18,2))",
    "all null": "cast(null as decimal(18,2))",
    "doubles": "sqrt(id % 400)",
    "longs": "id % 17",
}


@pytest.mark.parametrize("value", VALUES.values(), ids=VALUES)
def test_distributed_rank_is_the_rank(spark, value):
    df = spark.range(1000, numPartitions=5).selectExpr("id as k", f"{value} as v")
    assert ranked(df) == expected(df)


def test_distributed_rank_of_no_rows(spark):
    df = spark.range(0).selectExpr("id as k", "cast(id as decimal(18,2)) as v")
    assert ranked(df) == []


def test_rank_needs_no_window(spark, capsys):
    df = spark.range(1000).selectExpr("id as k", "cast(id % 40 as decimal(18,2)) as v")
    ranking.rank_descending(df, "v", "r").explain()
    plan = capsys.readouterr().out
    assert "rank(" not in plan and "partial_min(" in plan


def test_rank_type_and_columns(spark):
    df = spark.createDataFrame([("a", 10)], "k string, v int")
    assert ranking.rank_descending(df, "v", "r").dtypes == [("k", "string"), ("v", "int"), ("r", "int")]


def test_running_total_with_null_month_first(spark):
    df = spark.createDataFrame([("2017-02", 3), (None, 1), ("2017-01", 2)], "m string, v int")
    got = ranking.running_total(df, "v", F.col("m").asc_nulls_first(), "t").collect()
    assert {r["m"]: r["t"] for r in got} == {None: 1, "2017-01": 3, "2017-02": 6}
