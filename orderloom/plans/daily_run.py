"""The daily run: CSV to raw, raw to silver, silver to marts.

Every table a run writes says what it was made from: the versions of its inputs and the settings that matter. A run
leaves out tables that are made from just what it would make them from, so a run that failed goes on where it
stopped, and one that finished is not repeated.

    spark-submit --py-files orderloom.zip orderloom/plans/daily_run.py \\
        --items .. --reviews .. --orders .. --raw .. --silver .. --marts .. --date 2024-01-15
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from orderloom.functions.typing import SCALE
from orderloom.operators import enrich, marts, paging, quality, skew
from orderloom.session import PARTITION_BYTES, build_session, counted_from_footers, scratch, shuffles_of, stored
from orderloom.sources import commits, csv, daily, records
from orderloom.sources.tables import JdbcTables, ParquetTables

SOURCES = ("order_items", "reviews", "orders")
SILVER = ("orders_enriched", "seller_ranking", "monthly_stats")
# The source of each side of the join.
SIDES = {"items": "order_items", "orders": "orders", "reviews": "reviews"}
MARTS = (
    "dm_order_status_performance",
    "dm_seller_performance",
    "dm_monthly_revenue",
    "dm_review_distribution",
)
# Only review comments hold line breaks; the other files are not searched for them.
MULTI_LINE = frozenset({"reviews"})
# Scores are read as doubles, since files may spell them 4.0; they become whole later.
TYPES = {
    "order_items": {"price": "double", "freight_value": "double"},
    "reviews": {"review_score": "double"},
    "orders": {},
}


@dataclass(frozen=True)
class Config:
    """Where a run reads and writes. ``csv`` maps each of SOURCES to a path.

    ``types`` gives raw columns a type while the CSV is read, so that rules on
    amounts reach the raw Parquet scan; other columns stay text. ``infer`` finds all
    types with a pass of its own, and a whole schema of a source in ``schemas`` goes
    before both. ``multi_line`` names the sources with line breaks inside quotes,
    whose files are split by ``records``. ``scale`` is the number of decimals that sums keep. ``again`` makes all
    tables anew, also those that are up to date; ``pages`` keeps the pages of every mart next to it. Shuffles get a partition per ``partition_bytes`` of the
    CSV files at least.
    """

    csv: dict[str, str]
    raw: str
    silver: str
    marts: ParquetTables | JdbcTables
    raw_files: int | None = None
    silver_files: int | None = None
    schemas: dict[str, StructType] = field(default_factory=dict)
    infer: bool = False
    types: dict[str, dict[str, str]] = field(default_factory=lambda: TYPES)
    multi_line: frozenset[str] = MULTI_LINE
    scale: int = SCALE
    again: bool = False
    pages: bool = False
    partition_bytes: int = PARTITION_BYTES


def _write_day(
    spark: SparkSession, cfg: Config, base: str, name: str, run_date: date, made_from: str | None, files: int | None, make: Callable[[], DataFrame]
) -> None:
    """Write a day of a table, unless it is there and made from the same."""
    if cfg.again or not commits.is_made_from(spark, daily.day_path(base, name, run_date), made_from):
        daily.write_day(make(), base, name, run_date, files, {commits.MADE_FROM: made_from})


def _versions(spark: SparkSession, base: str, names: tuple[str, ...], run_date: date) -> dict[str, str | None]:
    return {name: commits.version(spark, daily.day_path(base, name, run_date)) for name in names}


def _keys(name: str) -> str:
    """The table of the kept sketches of a source's orders."""
    return f"{name}.keys"


def ingest(spark: SparkSession, cfg: Config, run_date: date) -> None:
    """Copy each CSV file to its day of the raw layer, and sketch which orders are frequent among its valid rows."""
    for name in SOURCES:
        read = records.read_records if name in cfg.multi_line else csv.read_csv
        schema, types = cfg.schemas.get(name), None if cfg.infer else cfg.types.get(name)
        settings = name in cfg.multi_line, schema.json() if schema else "", cfg.infer, types or {}, cfg.raw_files or 0
        made_from = commits.digest("raw", commits.listing(spark, cfg.csv[name]), settings)
        _write_day(
            spark, cfg, cfg.raw, name, run_date, made_from, cfg.raw_files,
            lambda: read(spark, cfg.csv[name], schema, cfg.infer, types=types),
        )
        made_from = commits.digest("keys", _versions(spark, cfg.raw, (name,), run_date))
        _write_day(
            spark, cfg, cfg.raw, _keys(name), run_date, made_from, None,
            lambda: skew.key_sketches(quality.valid(daily.read_day(spark, cfg.raw, name, run_date), name), enrich.KEY),
        )


def _hot_orders(spark: SparkSession, cfg: Config, raw: dict[str, DataFrame], run_date: date) -> skew.HotKeys | None:
    """The hot orders by the sketches kept with the raw day; None if the day has none, or ids of different types."""
    days = {side: daily.day_path(cfg.raw, _keys(name), run_date) for side, name in SIDES.items()}
    kinds = {raw[name].schema[enrich.KEY].dataType for name in SIDES.values()}
    if len(kinds) > 1 or not all(commits.version(spark, path) for path in days.values()):
        return None
    return skew.kept_hot_keys({side: commits.read(spark, path) for side, path in days.items()}, enrich.KEY, kinds.pop())


def refine(spark: SparkSession, cfg: Config, run_date: date) -> None:
    """Type, validate and join one raw day; write it with its two summaries.

    The join runs once. Both summaries read the written rows and only the columns
    they need.
    """

    def joined() -> DataFrame:
        raw = {name: daily.read_day(spark, cfg.raw, name, run_date) for name in SOURCES}
        items, orders, reviews = (quality.valid(raw[name], name) for name in ("order_items", "orders", "reviews"))
        return enrich.orders_enriched(items, orders, reviews, _hot_orders(spark, cfg, raw, run_date))

    def sellers() -> DataFrame:
        return marts.seller_ranking(enrich.row_facts(rows, "price", "seller_id", scale=cfg.scale))

    def months() -> DataFrame:
        return marts.monthly_stats(enrich.row_facts(rows, "total_amount", "order_purchase_timestamp", scale=cfg.scale))

    files = cfg.silver_files or 0
    made_from = commits.digest("enriched", _versions(spark, cfg.raw, SOURCES, run_date), files)
    _write_day(spark, cfg, cfg.silver, "orders_enriched", run_date, made_from, cfg.silver_files, joined)
    rows = daily.read_day(spark, cfg.silver, "orders_enriched", run_date)
    version = _versions(spark, cfg.silver, ("orders_enriched",), run_date)
    for name, make in (("seller_ranking", sellers), ("monthly_stats", months)):
        made_from = commits.digest(name, version, cfg.scale, files)
        _write_day(spark, cfg, cfg.silver, name, run_date, made_from, cfg.silver_files, make)


def publish(spark: SparkSession, cfg: Config, run_date: date) -> None:
    """Replace the four marts with those of one silver day."""
    silver = {name: daily.read_day(spark, cfg.silver, name, run_date) for name in SILVER}
    versions = _versions(spark, cfg.silver, SILVER, run_date)
    held: list[DataFrame] = []

    def groups() -> DataFrame:
        # Status and review marts share one scan: both add up from (status, delay) groups.
        if not held:
            facts = enrich.row_facts(
                silver["orders_enriched"], "total_amount", "order_status", "delivery_delay_days", scale=cfg.scale
            )
            held.append(stored(enrich.by_status_and_delay(facts)))
        return held[0]

    made: dict[str, tuple[str, Callable[[], DataFrame]]] = {
        "dm_order_status_performance": ("orders_enriched", lambda: marts.status_performance(groups())),
        "dm_seller_performance": ("seller_ranking", lambda: marts.seller_mart(silver["seller_ranking"])),
        "dm_monthly_revenue": ("monthly_stats", lambda: marts.month_mart(silver["monthly_stats"])),
        "dm_review_distribution": ("orders_enriched", lambda: marts.review_distribution(groups())),
    }
    for name, (source, make) in made.items():
        made_from = commits.digest(name, {source: versions[source]}, cfg.scale)
        if cfg.again or not cfg.marts.is_made_from(spark, name, made_from):
            cfg.marts.replace(make(), name, made_from=made_from)
        if cfg.pages:
            cfg.marts.replace_pages(cfg.marts.read(spark, name), name, paging.mart_order(name))


def run_report(spark: SparkSession, cfg: Config, run_date: date) -> DataFrame:
    """Row counts of a finished run: stage, name, n_rows.

    Counted by one pass per raw source for its rules, and on the footers of the other written tables.
    """
    def count(df: DataFrame, stage: str, name: str) -> DataFrame:
        return df.agg(F.count("*").alias("n_rows")).select(
            F.lit(stage).alias("stage"), F.lit(name).alias("name"), "n_rows"
        )

    def silver(name: str) -> DataFrame:
        return daily.read_day(spark, cfg.silver, name, run_date)

    raw = {name: daily.read_day(spark, cfg.raw, name, run_date) for name in SOURCES}
    parts = []
    for name, df in raw.items():
        # The first rule of a source is given all its rows, so one pass counts both.
        rules = quality.funnel(df, name).withColumn("is_first", F.col("rule") == quality.RULES[name][0].code)
        read = F.struct(F.lit("raw").alias("stage"), F.col("source").alias("name"), F.col("n_in").alias("n_rows"))
        kept = F.struct(F.lit("rule").alias("stage"), F.col("rule").alias("name"), F.col("n_kept").alias("n_rows"))
        parts.append(rules.select(F.inline(F.when(F.col("is_first"), F.array(read, kept)).otherwise(F.array(kept)))))
    with counted_from_footers(spark):
        parts += [count(silver(name), "silver", name) for name in SILVER]
        parts += [count(cfg.marts.read(spark, name), "mart", name) for name in MARTS]
    return reduce(DataFrame.unionByName, parts)


def run_day(spark: SparkSession, cfg: Config, run_date: date) -> None:
    """All three stages for one day, in order; the first failure stops the run.

    Steps that are kept between them go with the run, finished or not.
    """
    n_bytes = sum(size for path in cfg.csv.values() for _, size, _ in commits.listing(spark, path))
    with scratch(spark), shuffles_of(spark, n_bytes, cfg.partition_bytes):
        ingest(spark, cfg, run_date)
        refine(spark, cfg, run_date)
        publish(spark, cfg, run_date)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one day from CSV to marts")
    for name in ("items", "reviews", "orders", "raw", "silver"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument(
        "--marts", help="folder of the Parquet marts; left out, they go to the database of JDBC_URL"
    )
    parser.add_argument("--date", required=True, type=date.fromisoformat)
    parser.add_argument("--raw-files", type=int)
    parser.add_argument("--silver-files", type=int)
    parser.add_argument("--infer", action="store_true", help="find column types, with one more pass")
    parser.add_argument("--single-line", action="store_true", help="no line breaks inside quotes: do not look for them")
    parser.add_argument("--again", action="store_true", help="make all tables anew, also those that are up to date")
    parser.add_argument("--pages", action="store_true", help="keep the pages of every mart next to it")
    parser.add_argument("--scale", type=int, default=SCALE, choices=range(7), help="decimals that sums of amounts keep")
    args = parser.parse_args(argv)
    tables = ParquetTables(args.marts) if args.marts else JdbcTables.from_environment()
    cfg = Config(
        {"order_items": args.items, "reviews": args.reviews, "orders": args.orders},
        args.raw, args.silver, tables, args.raw_files, args.silver_files, infer=args.infer,
        multi_line=frozenset() if args.single_line else MULTI_LINE, scale=args.scale, again=args.again, pages=args.pages,
    )
    spark = build_session("orderloom daily run")
    run_day(spark, cfg, args.date)
    for row in run_report(spark, cfg, args.date).collect():
        print(f"{row['stage']:<7} {row['name']:<28} {row['n_rows']:>14,}")


if __name__ == "__main__":
    main()
