"""Declared quality rules, the filters they stand for and their rejection report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import typing


@dataclass(frozen=True)
class Rule:
    code: str
    text: str
    keep: Callable[[], Column]


def _number(amount: str) -> Column:
    """NaN compares as larger than any number, and is none."""
    return ~F.isnan(F.col(amount).cast("double"))


# A comparison with null is null, so a row with a null amount or score is dropped.
# Bare columns against literals: on a Parquet source the rules reach the scan.
RULES: dict[str, list[Rule]] = {
    "order_items": [
        Rule("R1", "order_id is present", lambda: F.col("order_id").isNotNull()),
        Rule("R2", "price is above 0", lambda: (F.col("price") > 0) & _number("price")),
        Rule(
            "R3",
            "freight is not negative",
            lambda: (F.col("freight_value") >= 0) & _number("freight_value"),
        ),
    ],
    "reviews": [
        Rule("R4", "score is from 1 to 5", lambda: F.col("review_score").between(1, 5)),
    ],
    "orders": [
        Rule("R5", "status is present", lambda: F.col("order_status").isNotNull()),
    ],
}


AMOUNTS = ("price", "freight_value")


def typed_items(items: DataFrame) -> DataFrame:
    return items.withColumns({c: typing.amount(items, c) for c in AMOUNTS})


def typed_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.withColumn("review_score", typing.whole_number(reviews, "review_score"))


ORDER_TIMES = (
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
)


def typed_orders(orders: DataFrame) -> DataFrame:
    return orders.withColumns({c: typing.timestamp(orders, c) for c in ORDER_TIMES})


TYPED = {"order_items": typed_items, "reviews": typed_reviews, "orders": typed_orders}


def valid(df: DataFrame, source: str) -> DataFrame:
    """Typed rows of one source that pass all its rules."""
    df = TYPED[source](df)
    for rule in RULES[source]:
        df = df.where(rule.keep())
    return df


def funnel(df: DataFrame, source: str) -> DataFrame:
    """Rows before and after each rule of one source, counted in a single pass.

    A plain aggregate and no accumulator: a task that runs twice after an executor
    is lost must not count twice.
    """
    rules = RULES[source]
    passed = [reduce(Column.__and__, [r.keep() for r in rules[:i]], F.lit(True)) for i in range(len(rules) + 1)]
    counts = TYPED[source](df).agg(*[F.count_if(p).alias(f"n{i}") for i, p in enumerate(passed)])
    steps = [
        F.struct(
            F.lit(source).alias("source"),
            F.lit(rule.code).alias("rule"),
            F.col(f"n{i}").alias("n_in"),
            F.col(f"n{i + 1}").alias("n_kept"),
        )
        for i, rule in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*steps)))


def quality_funnel(items: DataFrame, reviews: DataFrame, orders: DataFrame) -> DataFrame:
    """The rejection report over the three sources: source, rule, n_in, n_kept."""
    sources = {"order_items": items, "reviews": reviews, "orders": orders}
    return reduce(DataFrame.unionByName, [funnel(df, name) for name, df in sources.items()])
