"""Parquet tables partitioned by run day, each day replaced in one step (see ``commits``)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import commits

PARTITION = ("year", "month", "day")


def stamped(df: DataFrame, run_date: date) -> DataFrame:
    """Add the run day as three int columns, as reading a whole table does."""
    return df.withColumns({p: F.lit(getattr(run_date, p)) for p in PARTITION})


def day_path(base: str, table: str, run_date: date) -> str:
    return "/".join([base, table, *(f"{p}={getattr(run_date, p)}" for p in PARTITION)])


def write_day(df: DataFrame, base: str, table: str, run_date: date, files: int | None = None, facts: dict | None = None) -> None:
    """Replace one day of a table, also with no rows at all, and leave its other days alone.

    The day's own folder is written, so the run day stands in its path and not in
    its files. ``files`` sets the number of files; left out, every task writes its
    own and no shuffle is added. A write that fails leaves the day as it was.
    """
    day = df.drop(*PARTITION)
    if files:
        day = day.repartition(files)
    commits.replace(day, day_path(base, table, run_date), facts=facts)


def read_day(spark: SparkSession, base: str, table: str, run_date: date) -> DataFrame:
    """One day of a table, without the partition columns.

    Reading the day's folder lists no other day, and a day nobody wrote is an error
    and not an empty table. Only files of the day's last finished write are read.
    """
    return commits.read(spark, day_path(base, table, run_date))
