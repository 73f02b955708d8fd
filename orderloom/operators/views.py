"""Reports over the stored marts: top sellers, shares, histograms, headline figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import dates
from ..functions.typing import exact
from .enrich import SCORES
from .paging import mart_order

TOP_DEFAULT, TOP_MIN, TOP_MAX = 20, 5, 50
SCATTER_ROWS = 200


def in_mart_order(mart: DataFrame, name: str) -> DataFrame:
    return mart.orderBy(*mart_order(name))


def top_sellers(sellers: DataFrame, n: int = TOP_DEFAULT) -> DataFrame:
    """The first ``n`` sellers by rank, ``n`` from 5 to 50."""
    if not TOP_MIN <= n <= TOP_MAX:
        raise ValueError(f"n must be from {TOP_MIN} to {TOP_MAX}, got {n}")
    return in_mart_order(sellers, "dm_seller_performance").limit(n)


def seller_scatter(sellers: DataFrame, n: int = SCATTER_ROWS) -> DataFrame:
    """Revenue, mean score and row count of the first sellers."""
    first = in_mart_order(sellers, "dm_seller_performance").limit(n)
    return first.select("total_revenue", "avg_review_score", "nb_orders")


def status_share(statuses: DataFrame) -> DataFrame:
    """Share of all rows per status."""
    total = statuses.agg(F.sum("nb_orders").alias("total")).scalar()
    return statuses.select("order_status", (F.col("nb_orders") / total).alias("share"))


def score_histogram(reviews: DataFrame) -> DataFrame:
    """Rows per score."""
    return reviews.groupBy("review_score").agg(F.sum("nb_orders").alias("nb_orders"))


def status_score_matrix(reviews: DataFrame) -> DataFrame:
    """Rows per status and score, one column per score, 0 where there are none."""
    wide = reviews.groupBy("order_status").pivot("review_score", list(SCORES)).agg(F.sum("nb_orders"))
    cells = [F.coalesce(F.col(str(s)), F.lit(0)).alias(f"score_{s}") for s in SCORES]
    return wide.select("order_status", *cells)


def revenue_kpis(months: DataFrame) -> DataFrame:
    """Total revenue and total rows."""
    revenue = F.sum(exact(F.col("monthly_revenue")))
    return months.agg(revenue.cast("double").alias("total_revenue"), F.sum("nb_orders").alias("nb_orders"))


def chart_series(months: DataFrame, statuses: DataFrame) -> DataFrame:
    """Points of the revenue charts: series, label, value."""
    points = [
        (months, "monthly_revenue", "order_month", "monthly_revenue"),
        (months, "cumulative_revenue", "order_month", "cumulative_revenue"),
        (statuses, "status_revenue", "order_status", "total_revenue"),
    ]
    frames = [
        df.select(F.lit(series).alias("series"), F.col(label).alias("label"), F.col(value).alias("value"))
        for df, series, label, value in points
    ]
    return reduce(DataFrame.unionByName, frames)


def month_display(months: DataFrame) -> DataFrame:
    """The month mart in order, with the month as a timestamp again."""
    shown = months.withColumn("order_month", dates.month_from_text("order_month"))
    return in_mart_order(shown, "dm_monthly_revenue")
