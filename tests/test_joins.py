"""The enriched join: grain, fan-out, and hot orders on any side."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderloom.operators import enrich, marts, quality, skew
from orderloom.sources import tpch

SF = "/root/testdata/sf0.001"
HOT = 7


def frames(spark, hot_items=False, hot_orders=False, hot_reviews=False):
    """Valid fixture rows; a third of the rows of the chosen tables go to one order."""

    def third(df, n):
        return df.withColumn("order_id", F.when(F.col(n) % 3 == 0, HOT).otherwise(F.col("order_id")))

    items = quality.valid(tpch.items(spark, SF), "order_items").where("seller_id <= 5 and order_id < 400")
    orders = quality.valid(tpch.orders(spark, SF), "orders").where("order_id < 200")
    reviews = quality.valid(tpch.reviews(spark, SF), "reviews").where("order_id < 300")
    if hot_items:
        items = third(items, "seller_id")
    if hot_orders:
        orders = third(orders, "customer_id")
    if hot_reviews:
        reviews = third(reviews, "review_id")
    return items, orders, reviews


# What the join means, as text: every item with every copy of its order and every review of that, or none.
PLAIN = """
SELECT i.order_id, {items}, {orders}, r.review_score, i.price + i.freight_value AS total_amount,
  datediff(o.order_delivered_customer_date, o.order_estimated_delivery_date) AS delivery_delay_days
FROM v_orders o LEFT OUTER JOIN v_reviews r ON r.order_id = o.order_id, LATERAL (SELECT * FROM v_items WHERE order_id = o.order_id) i
"""


def plain_join(items, orders, reviews):
    for name, df in (("v_items", items), ("v_orders", orders), ("v_reviews", reviews)):
        df.createOrReplaceTempView(name)
    names = {"items": [f"i.{c}" for c in items.columns[1:]], "orders": [f"o.{c}" for c in orders.columns[1:]]}
    return items.sparkSession.sql(PLAIN.format(**{k: ", ".join(v) for k, v in names.items()}))


def rows(df):
    """Distinct rows and how often each occurs."""
    columns = sorted(df.columns)
    return Counter({tuple(r)[:-1]: r["copies"] for r in df.groupBy(*columns).agg(F.count("*").alias("copies")).collect()})


CASES = [
    dict(),
    dict(hot_items=True),
    dict(hot_orders=True),
    dict(hot_reviews=True),
    dict(hot_items=True, hot_reviews=True),
    dict(hot_items=True, hot_orders=True, hot_reviews=True),
]


def hot(spark, items, orders, reviews):
    return skew.hot_keys({"items": items, "orders": orders, "reviews": reviews}, "order_id")


@pytest.mark.parametrize("case", CASES, ids=str)
def test_enriched_equals_plain_join(spark, case):
    sides = frames(spark, **case)
    found = hot(spark, *sides)
    assert (found.table is not None) == bool(case)
    got = enrich.orders_enriched(*sides, hot=found)
    assert got.columns == plain_join(*sides).columns
    assert rows(got) == rows(plain_join(*sides))


@pytest.mark.parametrize("case", CASES, ids=str)
def test_marts_equal_those_of_the_rows(spark, case):
    sides = frames(spark, **case)
    joined = plain_join(*sides)
    seller = skew.hot_keys({"items": sides[0]}, "order_id")
    order = skew.hot_keys({"orders": sides[1]}, "order_id")
    assert (seller.table is not None) == bool(case.get("hot_items"))
    assert (order.table is not None) == bool(case.get("hot_orders"))
    facts = enrich.order_facts(*sides, hot=order)
    of_rows = enrich.row_facts(
        joined, "total_amount", "order_status", "order_purchase_timestamp", "delivery_delay_days"
    )
    for mart in (marts.status_performance, marts.review_distribution, marts.monthly_stats):
        assert rows(mart(facts)) == rows(mart(of_rows))
    by_group = enrich.by_status_and_delay(of_rows)
    for mart in (marts.status_performance, marts.review_distribution):
        assert rows(mart(by_group)) == rows(mart(of_rows))
    assert rows(marts.seller_stats(enrich.seller_facts(*sides, hot=seller))) == rows(
        marts.seller_stats(enrich.row_facts(joined, "price", "seller_id"))
    )


def test_marts_equal_plain_aggregates(spark):
    sides = frames(spark, hot_items=True)
    joined = plain_join(*sides)
    exact = F.col("total_amount").cast("decimal(38,6)")
    plain = joined.groupBy("order_status").agg(
        F.count("order_id").alias("nb_orders"),
        (F.sum(exact).cast("double") / F.count("order_id")).alias("avg_amount"),
        F.avg("review_score").alias("avg_review_score"),
        F.avg("delivery_delay_days").alias("avg_delay_days"),
        F.sum(exact).cast("double").alias("total_revenue"),
    )
    assert rows(marts.status_performance(enrich.order_facts(*sides))) == rows(plain)
    plain = (
        joined.where("review_score is not null")
        .groupBy("review_score", "order_status")
        .agg(F.count("order_id").alias("nb_orders"), F.avg("delivery_delay_days").alias("avg_delay_days"))
    )
    assert rows(marts.review_distribution(enrich.order_facts(*sides))) == rows(plain)


def test_wrong_hot_keys_do_not_change_the_result(spark):
    sides = frames(spark, hot_items=True)
    table = spark.createDataFrame(
        [(HOT, 3, 2, 4), (1, 2, 2, 2), (10**9, 5, 5, 5)],
        "order_id bigint, splits_items int, splits_orders int, splits_reviews int",
    )
    wrong = skew.HotKeys("order_id", enrich.ROW_SIDES, table)
    assert rows(enrich.orders_enriched(*sides, hot=wrong)) == rows(plain_join(*sides))


def test_items_without_an_order_are_not_copied(spark):
    """An id that is hot in items and reviews but unknown to orders costs nothing extra."""
    items, orders, reviews = frames(spark, hot_items=True, hot_reviews=True)
    orders = orders.where(F.col("order_id") != HOT)
    assert rows(enrich.orders_enriched(items, orders, reviews, hot(spark, items, orders, reviews))) == rows(
        plain_join(items, orders, reviews)
    )


def test_one_search_serves_all_joins(spark):
    sides = frames(spark, hot_items=True, hot_orders=True, hot_reviews=True)
    found = hot(spark, *sides)
    assert found.sides == enrich.ROW_SIDES
    n = plain_join(*sides).count()
    for facts in (enrich.order_facts, enrich.seller_facts):
        assert facts(*sides, hot=found).agg(F.sum("n_rows")).first()[0] == n
    assert found.only("items").join_on == ["order_id", "salt_items"]
    assert found.only("other") == skew.HotKeys("order_id")


def test_hot_rows_are_dealt_out(spark):
    items, orders, reviews = frames(spark, hot_items=True)
    found = skew.hot_keys({"items": items}, "order_id")
    dealt = found.spread(items, "items").where(F.col("order_id") == HOT).groupBy("salt_items").count().collect()
    assert len(dealt) >= 2
    sizes = [r["count"] for r in dealt]
    assert max(sizes) < 2 * min(sizes)
    copies = found.spread(orders.where(F.col("order_id") == HOT)).count()
    assert copies == len(dealt) * orders.where(F.col("order_id") == HOT).count()


def test_copies_are_generated_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(enrich, "BLOCK", 7)
    sides = frames(spark, hot_reviews=True)
    assert rows(enrich.orders_enriched(*sides)) == rows(plain_join(*sides))


def test_no_hot_key_adds_nothing_to_the_plan(spark, capsys):
    sides = frames(spark)
    assert hot(spark, *sides).table is None
    enrich.orders_enriched(*sides).explain()
    assert "salt" not in capsys.readouterr().out


def test_text_keys(spark):
    items = spark.createDataFrame([("x",)] * 50 + [(str(i),) for i in range(50)] + [(None,)] * 90, "order_id string")
    found = skew.hot_keys({"items": items}, "order_id")
    assert [tuple(r) for r in found.table.collect()] == [("x", 4)]


def test_weights_larger_than_any_table(spark):
    """A billion reviews of an order worth a lot: counted, never built."""
    joined = spark.range(1).selectExpr("'s' as seller_id", f"{10**9}L as n_scored", "4L as score_sum", *[f"0L as n_{s}" for s in range(1, 6)])
    facts = enrich._facts(joined, ["seller_id"], F.lit(10**6).cast("bigint"), F.lit(10**15).cast("decimal(38,6)"))
    row = marts.seller_stats(facts).first()
    assert (row["nb_orders"], row["total_revenue"]) == (10**15, 1e24)


def test_search_with_very_many_partitions(spark):
    """As many as a very large job has; past 16,384 a sketch would need more than Spark allows."""
    items = spark.range(20_000).selectExpr("if(id % 3 = 0, 7, id) as order_id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    spark.conf.set("spark.sql.shuffle.partitions", "20000")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "8")
    try:
        found = skew.hot_keys({"items": items}, "order_id")
        top = {r["order_id"]: r["splits_items"] for r in found.table.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        if adaptive is None:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
    assert 6000 < top[7] < 7500


def test_search_is_merged_by_slices(spark, monkeypatch):
    plans = []
    collect = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: plans.append(df._jdf.queryExecution().toString()) or collect(df))
    ids = spark.range(100).withColumnRenamed("id", "order_id")
    skew.hot_keys({"items": ids, "orders": ids}, "order_id")
    exchanges = [line for line in plans[-1].split("\n") if "Exchange hashpartitioning(" in line]
    assert exchanges and all("_groupingexpression" in line for line in exchanges)


def test_scores_out_of_range_keep_the_item(spark):
    items, orders, _ = frames(spark)
    reviews = orders.selectExpr("order_id", "9 as review_score")
    got = enrich.orders_enriched(items, orders, reviews)
    assert got.count() == items.join(orders, "order_id").count()
    assert got.where("review_score is not null").isEmpty()


def test_reviews_fan_out(spark):
    items = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), ("c", 1), ("d", 1)], "order_id string, seller_id int")
    items = items.selectExpr("*", "cast(10 as decimal(18,2)) price", "cast(1 as decimal(18,2)) freight_value")
    orders = spark.createDataFrame([("a",), ("b",), ("c",)], "order_id string").selectExpr(
        "*", "'x' order_status", "timestamp'2017-01-01 00:00:00' order_purchase_timestamp",
        "timestamp'2017-01-05 00:00:00' order_delivered_customer_date",
        "timestamp'2017-01-03 00:00:00' order_estimated_delivery_date",
    )
    reviews = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9), ("z", 3)], "order_id string, review_score int")
    got = enrich.orders_enriched(items, orders, quality.valid(reviews, "reviews"))
    assert sorted((r["order_id"], r["seller_id"], r["review_score"] or 0) for r in got.collect()) == [
        ("a", 1, 1), ("a", 1, 5), ("a", 2, 1), ("a", 2, 5), ("b", 1, 0), ("c", 1, 0),
    ]
    assert {(r["total_amount"], r["delivery_delay_days"]) for r in got.collect()} == {(11, 2)}
    assert got.columns.count("order_id") == 1


def test_totals_agree_between_marts(spark):
    sides = frames(spark)
    n = enrich.orders_enriched(*sides).count()
    facts = enrich.order_facts(*sides)
    months = marts.monthly_stats(facts).orderBy(F.col("order_month").asc_nulls_first()).collect()
    assert sum(r["nb_orders"] for r in months) == n
    assert sum(r["nb_orders"] for r in marts.status_performance(facts).collect()) == n
    sellers = marts.seller_stats(enrich.seller_facts(*sides))
    assert sellers.agg(F.sum("nb_orders")).first()[0] == n
    assert months[-1]["cumulative_revenue"] == pytest.approx(sum(r["monthly_revenue"] for r in months))
    assert months[0]["order_month"] is None
