"""Rules R1 to R5 and their funnel on literal rows."""

from __future__ import annotations

from orderloom.operators import quality

ITEMS = "order_id string, seller_id string, price double, freight_value double"


def items(spark):
    nan, inf = float("nan"), float("inf")
    return spark.createDataFrame(
        [
            (None, "s", 1.0, 1.0),
            ("a", "s", None, 1.0),
            ("b", "s", nan, 1.0),
            ("c", "s", 0.0, 1.0),
            ("d", "s", -1.0, 1.0),
            ("e", "s", inf, 1.0),
            ("f", "s", 0.01, -1.0),
            ("g", "s", 0.01, None),
            ("h", "s", 0.01, nan),
            ("i", "s", 0.01, 0.0),
            ("j", "s", 2e16, 3e16),
            ("k", "s", 0.004, 12.345),
        ],
        ITEMS,
    )


def test_item_rules(spark):
    rows = quality.valid(items(spark), "order_items").collect()
    assert [(r["order_id"], r["price"], r["freight_value"]) for r in rows] == [
        ("e", float("inf"), 1.0), ("i", 0.01, 0.0), ("j", 2e16, 3e16), ("k", 0.004, 12.345),
    ]


def test_review_rule(spark):
    df = spark.createDataFrame([("a", s) for s in ("0", "1", "5", "6", "5.9", "x", None)], "order_id string, review_score string")
    assert [r["review_score"] for r in quality.valid(df, "reviews").collect()] == [1, 5, 5]


def test_order_rule_keeps_status_text(spark):
    df = spark.createDataFrame(
        [("a", " Odd ", "2017-01-01 00:00:00", "bad", None), ("b", None, None, None, None)],
        "order_id string, order_status string, order_purchase_timestamp string, "
        "order_delivered_customer_date string, order_estimated_delivery_date string",
    )
    (row,) = quality.valid(df, "orders").collect()
    assert (row["order_status"], row["order_delivered_customer_date"]) == (" Odd ", None)
    assert row["order_purchase_timestamp"] is not None


def test_funnel_counts_each_rule(spark):
    rows = quality.funnel(items(spark), "order_items").collect()
    assert [tuple(r) for r in rows] == [
        ("order_items", "R1", 12, 11),
        ("order_items", "R2", 11, 7),
        ("order_items", "R3", 7, 4),
    ]


def test_funnel_of_no_rows(spark):
    assert [r["n_in"] for r in quality.funnel(items(spark).limit(0), "order_items").collect()] == [0, 0, 0]


def test_rules_reach_the_parquet_scan(spark, tmp_path, capsys):
    path = str(tmp_path / "items")
    items(spark).write.parquet(path)
    quality.valid(spark.read.parquet(path), "order_items").explain("formatted")
    plan = capsys.readouterr().out
    assert "GreaterThan(price,0.0)" in plan and "GreaterThanOrEqual(freight_value,0.0)" in plan
    assert "IsNotNull(order_id)" in plan
