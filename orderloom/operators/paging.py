"""Pages of a stored table in a fixed order."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import stored
from ..sources import commits

DEFAULT_SIZE = 20
MAX_SIZE = 100
# Stored pages lie in row groups of this size, so a page reads little more than its rows.
GROUP_BYTES = 4 << 20


def mart_order(mart: str) -> list[Column]:
    """Order in which a mart is served: its key, then a tie-break that makes it total.

    Nulls come last, also in ascending order.
    """
    if mart == "dm_seller_performance":
        return [F.col("revenue_rank").asc_nulls_last(), F.col("seller_id").asc_nulls_last()]
    if mart == "dm_monthly_revenue":
        return [F.col("order_month").asc_nulls_last()]
    if mart == "dm_order_status_performance":
        return [F.col("nb_orders").desc_nulls_last(), F.col("order_status").asc_nulls_last()]
    if mart == "dm_review_distribution":
        return [F.col("review_score").asc_nulls_last(), F.col("order_status").asc_nulls_last()]
    raise KeyError(mart)


@dataclass(frozen=True)
class Page:
    total: int
    page: int
    page_size: int
    data: DataFrame


def number_rows(df: DataFrame, order: list[Column], out: str = "row_number") -> DataFrame:
    """Number the rows from 1 in the given order, sorted on all tasks.

    Each sorted partition numbers its own rows; the numbers are stored with the
    rows before partition sizes turn them into positions, so both see one sort. Rows that the order leaves
    equal are put in order by a hash of all their columns, and rows that are equal altogether by the task they
    come from, so that many of them do not meet in one task.
    """
    ties = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)) if df.columns else F.lit(0)
    tied = df.withColumns({"_ties": ties, "_from": F.spark_partition_id()}).orderBy(*order, "_ties", "_from")
    placed = stored(tied.drop("_ties", "_from").withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    # One row per sorted partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    in_part = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_before") + in_part + 1).alias(out)
    )


def total_order(df: DataFrame, order: list[Column] | None = None) -> list[Column]:
    """The order, or the first column's, with all columns as tie-breaks.

    Rows that are equal in all columns stay without an order, and may: whichever of
    them a page shows, it shows the same values.
    """
    return [*(order or []), *(F.col(f"`{c}`").asc_nulls_last() for c in df.columns)]


class Pages:
    """A table sorted and numbered once, from which any page is a range of numbers."""

    def __init__(self, df: DataFrame, order: list[Column] | None = None, where: Column | None = None):
        rows = df if where is None else df.where(where)
        self.numbered = number_rows(rows, total_order(rows, order))
        self.total = self.numbered.count()

    def page(self, page: int = 1, page_size: int = DEFAULT_SIZE) -> Page:
        """One page; a page past the end is empty."""
        _check(page, page_size)
        last = page * page_size
        wanted = F.col("row_number").between(last - page_size + 1, last)
        # At most a page of rows: put in order without a sort of its own.
        rows = self.numbered.where(wanted).orderBy("row_number").limit(page_size).drop("row_number")
        return Page(self.total, page, page_size, rows)


def store(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """Sort and number a table for good: ``StoredPages`` then reads its pages without another sort.

    Every file holds a range of numbers in order, and the commit says how many rows there are. The pages are
    replaced in one step, as tables are.
    """
    numbered = number_rows(df, total_order(df, order))
    dealt = numbered.repartitionByRange("row_number").sortWithinPartitions("row_number")
    options = {"parquet.block.size": str(GROUP_BYTES)}
    commits.replace(dealt, path, facts=lambda rows: {"total": rows.count()}, options=options)


class StoredPages(Pages):
    """The pages kept by ``store``. A page is a range of numbers that Parquet looks up in its own statistics."""

    def __init__(self, spark: SparkSession, path: str):
        self.numbered = commits.read(spark, path)
        self.total = commits.facts(spark, path)["total"]


def _check(page: int, page_size: int) -> None:
    if page < 1:
        raise ValueError(f"page must be at least 1, got {page}")
    if not 1 <= page_size <= MAX_SIZE:
        raise ValueError(f"page_size must be from 1 to {MAX_SIZE}, got {page_size}")


def page(
    df: DataFrame,
    page: int = 1,
    page_size: int = DEFAULT_SIZE,
    order: list[Column] | None = None,
    where: Column | None = None,
) -> Page:
    """One page and the total row count; ``where`` filters rows and total alike.

    The default order is by the columns from left to right. To read several pages,
    make ``Pages`` once: the table is then sorted once.
    """
    _check(page, page_size)
    return Pages(df, order, where).page(page, page_size)


def all_pages(df: DataFrame, order: list[Column] | None = None, page_size: int = MAX_SIZE) -> DataFrame:
    """The whole table with the number of the page each row is on."""
    number = F.ceil(F.col("row_number") / page_size).cast("int")
    return number_rows(df, total_order(df, order)).withColumn("page", number).drop("row_number")
