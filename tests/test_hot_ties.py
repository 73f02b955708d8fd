"""Ranks and positions where many rows share a value: rows per sorted partition, and joins without them."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from orderloom.operators import paging, ranking

TASKS = 25


@pytest.fixture()
def many_tasks(spark):
    settings = {"spark.sql.shuffle.partitions": str(TASKS), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


# Half of all rows hold one value; in the second case they are equal in all columns.
HALF = {
    "one value": ("if(id % 2 = 0, 500, id) as v", "id as k"),
    "equal rows": ("if(id % 2 = 0, 500, id) as v", "if(id % 2 = 0, 0, id) as k"),
    "half are null": ("if(id % 2 = 0, null, id) as v", "id as k"),
}


@pytest.mark.parametrize("columns", HALF.values(), ids=HALF)
def test_no_task_sorts_much_more_than_its_share(many_tasks, monkeypatch, columns):
    n, placed, stored = 50_000, [], paging.stored
    monkeypatch.setattr(paging, "stored", lambda df: placed.append(stored(df)) or placed[-1])
    df = many_tasks.range(n, numPartitions=200).selectExpr(*columns)
    got = ranking.rank_descending(df, "v", "r")
    expected = df.withColumn("r", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert got.exceptAll(expected).count() == 0 == expected.exceptAll(got).count()
    sizes = [r["count"] for r in placed[0].groupBy(F.shiftright("_place", 33).alias("p")).count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * n / TASKS, sorted(sizes)


def test_rows_of_a_frequent_value_are_not_shuffled_to_their_rank(many_tasks, capsys):
    many_tasks.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = many_tasks.range(20_000).selectExpr("id as k", "if(id % 2 = 0, 1, id) as v")
        got = ranking.rank_descending(df, "v", "r")
        assert got.where("v = 1").select("r").distinct().collect()[0]["r"] == 10_000
        got.explain()
        plan = capsys.readouterr().out
    finally:
        many_tasks.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


def test_positions_of_equal_rows(many_tasks):
    df = many_tasks.range(10_000, numPartitions=40).selectExpr("cast(1 as int) as a", "id % 2 as b")
    got = paging.number_rows(df, paging.total_order(df)).select("row_number", "b").collect()
    assert sorted(r["row_number"] for r in got) == list(range(1, 10_001))
    assert all(r["b"] == (r["row_number"] > 5000) for r in got)
