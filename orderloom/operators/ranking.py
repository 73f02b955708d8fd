"""Competition rank and running total over a whole table, without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .paging import number_rows


# A value is frequent if it holds this share of the rows of an average shuffle partition.
FREQUENT = 8


def rank_descending(df: DataFrame, value: str, out: str) -> DataFrame:
    """``rank()`` by ``value`` descending, nulls last: ties share a rank and leave a gap.

    One plan for all sizes: a distributed sort numbers the rows, ties spread over tasks, and the rank of a value is
    the smallest number among its rows. That minimum is taken per task before it is shuffled. Ranks
    of frequent values, of which there are at most ``FREQUENT`` per shuffle partition, are sent to the rows; only
    rows of other values, each with a small part of a task's rows, are shuffled to meet theirs.
    """
    numbered = number_rows(df, [F.col(value).desc_nulls_last()], "_number")
    firsts = numbered.groupBy(F.col(value).alias("_value")).agg(F.min("_number").alias(out), F.count("*").alias("_n"))
    slots = FREQUENT * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frequent = F.col("_n") * slots >= numbered.count()
    most, rest = (firsts.where(c).withColumn("_found", F.lit(True)).drop("_n") for c in (frequent, ~frequent))
    same = F.col(value).eqNullSafe(F.col("_value"))
    known = numbered.join(F.broadcast(most), same, "left")
    by_rank = [*(F.col(f"`{c}`") for c in df.columns), F.col(out).cast("int").alias(out)]
    others = known.where("_found is null").select(*(F.col(f"`{c}`") for c in df.columns))
    return known.where("_found").select(*by_rank).unionByName(others.join(rest, same).select(*by_rank))


def running_total(df: DataFrame, value: str, order: Column, out: str) -> DataFrame:
    """Running sum in the given order, for a table whose length the calendar bounds."""
    return df.withColumn(out, F.sum(value).over(Window.orderBy(order)))
