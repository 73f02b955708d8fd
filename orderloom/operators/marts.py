"""Seller, month, status and review aggregates.

Each takes facts in counted form (see ``enrich``), so the same code serves raw
inputs and stored enriched rows. ``nb_orders`` counts enriched rows: an order
with two items and two reviews counts four times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates
from ..functions.typing import as_double
from . import ranking
from .enrich import PER_SCORE, SCORES


def _nb_orders() -> Column:
    return F.sum("n_rows").alias("nb_orders")


# Means divide sums taken as doubles: exact for whole numbers up to 9e15, whatever
# the order of the rows, and without an overflow beyond.


def _double_sum(value: Column) -> Column:
    return F.sum(value.cast("double"))


def _avg_score() -> Column:
    return F.try_divide(_double_sum(F.col("score_sum")), _double_sum(F.col("n_scored")))


def _avg_delay(weight: str) -> Column:
    """Mean delay over the delivered rows, each counted ``weight`` times."""
    delay, rows = F.col("delivery_delay_days"), F.col(weight).cast("double")
    return F.try_divide(_double_sum(delay * rows), _double_sum(F.when(delay.isNotNull(), rows)))


def seller_stats(facts: DataFrame) -> DataFrame:
    """Rows, revenue (price only) and mean score per seller."""
    return facts.groupBy("seller_id").agg(
        _nb_orders(),
        F.sum("amount").cast("double").alias("total_revenue"),
        _avg_score().alias("avg_review_score"),
    )


def seller_ranking(facts: DataFrame) -> DataFrame:
    """Sellers with their competition rank by revenue."""
    return ranking.rank_descending(seller_stats(facts), "total_revenue", "revenue_rank")


def monthly_stats(facts: DataFrame) -> DataFrame:
    """Rows and revenue (with freight) per purchase month, and revenue so far.

    Orders without a purchase time form a null month, which comes first.
    """
    months = facts.groupBy(dates.month_start("order_purchase_timestamp").alias("order_month")).agg(
        _nb_orders(), F.sum("amount").alias("monthly_revenue")
    )
    totals = ranking.running_total(
        months, "monthly_revenue", F.col("order_month").asc_nulls_first(), "cumulative_revenue"
    )
    return as_double(totals, "monthly_revenue", "cumulative_revenue")


def status_performance(facts: DataFrame) -> DataFrame:
    """Rows, amounts, mean score and mean delay per order status."""
    revenue = F.sum("amount").cast("double")
    return facts.groupBy("order_status").agg(
        _nb_orders(),
        (revenue / F.sum("n_rows").cast("double")).alias("avg_amount"),
        _avg_score().alias("avg_review_score"),
        _avg_delay("n_rows").alias("avg_delay_days"),
        revenue.alias("total_revenue"),
    )


def review_distribution(facts: DataFrame) -> DataFrame:
    """Rows and mean delay per score and order status, reviewed rows only.

    All scores are summed side by side per status and turned into rows afterwards,
    so the facts are neither multiplied nor read five times.
    """
    measures = [
        m
        for n in PER_SCORE
        for m in (F.sum(n).alias(f"nb_{n}"), _avg_delay(n).alias(f"delay_{n}"))
    ]
    rows = [
        F.struct(
            F.lit(s).alias("review_score"),
            F.col("order_status"),
            F.col(f"nb_{n}").alias("nb_orders"),
            F.col(f"delay_{n}").alias("avg_delay_days"),
        )
        for s, n in zip(SCORES, PER_SCORE)
    ]
    wide = facts.groupBy("order_status").agg(*measures)
    return wide.select(F.inline(F.array(*rows))).where(F.col("nb_orders") > 0)


def seller_mart(ranked: DataFrame) -> DataFrame:
    return ranked.select("seller_id", "nb_orders", "total_revenue", "avg_review_score", "revenue_rank")


def month_mart(monthly: DataFrame) -> DataFrame:
    """Monthly stats with the month as text."""
    return monthly.select(
        F.col("order_month").cast("string").alias("order_month"),
        "nb_orders",
        "monthly_revenue",
        "cumulative_revenue",
    )
