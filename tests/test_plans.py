"""Shape of the physical plans when no side is small enough to broadcast."""

from __future__ import annotations

import re

import pytest

from orderloom.operators import enrich, marts, quality, skew
from orderloom.sources import tpch

SF = "/root/testdata/sf0.001"
NONE_HOT = skew.HotKeys("order_id")


@pytest.fixture()
def sides(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    sources = ((tpch.items, "order_items"), (tpch.orders, "orders"), (tpch.reviews, "reviews"))
    yield [quality.valid(read(spark, SF), name) for read, name in sources]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


def exchanges(text: str) -> list[str]:
    return re.findall(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition)\(?([a-z_]*)", text)


def read_schema(text: str, column: str) -> set[str]:
    (schema,) = [s for s in re.findall(r"ReadSchema: struct<(.*)>", text) if column in s]
    return set(re.findall(r"(\w+):", schema))


def test_full_join_shuffles_each_input_once(sides, capsys):
    text = plan(enrich.orders_enriched(*sides, hot=NONE_HOT), capsys)
    assert exchanges(text) == [("hashpartitioning", "order_id")] * 3
    assert "Cartesian" not in text and "BroadcastNestedLoop" not in text


def test_seller_mart_shuffles_each_input_and_the_groups(sides, capsys):
    text = plan(marts.seller_stats(enrich.seller_facts(*sides, hot=NONE_HOT)), capsys)
    assert sorted(exchanges(text)) == [("hashpartitioning", "order_id")] * 3 + [("hashpartitioning", "seller_id")]
    assert not read_schema(text, "l_orderkey") & {"l_linenumber", "l_discount", "l_shipdate"}
    assert read_schema(text, "o_orderkey") == {"o_orderkey", "o_custkey", "o_orderstatus"}


def test_marts_sum_before_the_shuffle(sides, capsys):
    text = plan(marts.status_performance(enrich.order_facts(*sides, hot=NONE_HOT)), capsys)
    tree = text.split("\n\n")[0]
    # Items and reviews are summed per order on both sides of their shuffle, facts per status too.
    assert tree.count("HashAggregate") == 6
    assert len(exchanges(text)) == 4
    assert "SortAggregate" not in tree and "ObjectHashAggregate" not in tree


def test_unused_score_counts_are_not_computed(sides, capsys):
    text = plan(marts.monthly_stats(enrich.order_facts(*sides, hot=NONE_HOT)), capsys)
    assert "n_scored" in text and "score_sum" not in text and "n_5" not in text


def test_stored_rows_need_one_shuffle_for_two_marts(spark, sides, tmp_path, capsys):
    path = str(tmp_path / "rows")
    enrich.orders_enriched(*sides).write.parquet(path)
    rows = spark.read.parquet(path)
    facts = enrich.row_facts(rows, "total_amount", "order_status", "delivery_delay_days")
    text = plan(enrich.by_status_and_delay(facts), capsys)
    assert len(exchanges(text)) == 1
    assert read_schema(text, "order_status") == {"order_status", "review_score", "total_amount", "delivery_delay_days"}


def test_hot_keys_are_the_only_broadcast(spark, sides, capsys):
    table = spark.createDataFrame([(7, 3)], "order_id bigint, splits_items int")
    hot = skew.HotKeys("order_id", ("items",), table)
    text = plan(enrich.orders_enriched(*sides, hot=hot), capsys)
    tree = text.split("\n\n")[0]
    assert tree.count("BroadcastExchange") + tree.count("ReusedExchange") == 3
    assert tree.count("BroadcastHashJoin LeftOuter") == 3 and tree.count("SortMergeJoin") == 2
