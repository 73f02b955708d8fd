"""Cleaning of the raw orders file and the contract of the table it fills."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import dates, text

# The order states the cleaned table accepts.
KNOWN_STATUSES = [
    "delivered", "shipped", "canceled", "processing",
    "invoiced", "unavailable", "approved", "created",
]

# The columns of the cleaned table.
DATE_COLUMNS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
COLUMNS = ["order_id", "customer_id", "order_status", *DATE_COLUMNS]


class ContractError(ValueError):
    """The rows break the key or not-null contract of their table."""


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in the given order.

    Spark keeps one row per key and task before the shuffle (WindowGroupLimit), so
    many copies of one key do not meet in one task.
    """
    nth = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("_nth", nth).where("_nth = 1").drop("_nth")


def clean_orders(raw: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """Cleaned orders: first copy per id, ids present, known status, canonical dates.

    The first copy is chosen before the other rules, so an order whose first copy
    is bad is lost even if a later one is good. Rows without an order id cannot
    survive and are left out before the shuffle. The result has all of ``COLUMNS``,
    whichever dates the input has; a missing one is null.
    """
    first = first_per_key(raw.where(F.col("order_id").isNotNull()), "order_id", order)
    return (
        first.where(F.col("customer_id").isNotNull())
        .withColumn("order_status", text.strip_lower(F.col("order_status")))
        .where(F.col("order_status").isin(KNOWN_STATUSES))
        .withColumns(
            {c: dates.canonical_text(c) if c in raw.columns else F.lit(None).cast("string") for c in DATE_COLUMNS}
        )
        .select(*COLUMNS)
    )


def clean_report(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: rows read, kept and rejected."""
    counts = raw.agg(F.count("*").alias("n_in")).withColumn(
        "n_kept", cleaned.agg(F.count("*").alias("n")).scalar()
    )
    return counts.withColumn("n_rejected", F.col("n_in") - F.col("n_kept"))


def check_contract(df: DataFrame, key: str, required: Sequence[str]) -> None:
    """Raise unless ``key`` is unique and the required columns have no nulls."""
    missing = [F.count_if(F.col(c).isNull()).alias(c) for c in required]
    per_key = df.groupBy(key).agg(F.count("*").alias("copies"), *missing)
    found = per_key.agg(
        F.count_if(F.col("copies") > 1).alias(f"repeated {key}"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"null {c}") for c in required],
    ).first()
    broken = {what: n for what, n in found.asDict().items() if n}
    if broken:
        raise ContractError(f"orders break their contract: {broken}")
