"""Clean an orders CSV into its checked table.

    spark-submit --py-files orderloom.zip orderloom/plans/clean_orders.py --input orders.csv --output tables
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from orderloom.operators import cleaning
from orderloom.session import build_session
from orderloom.sources import csv, records
from orderloom.sources.tables import ORDERS_TABLE, JdbcTables, ParquetTables, replace_orders


def raw_orders(spark: SparkSession, path: str | list[str], multi_line: bool = True) -> DataFrame:
    """The orders files as text with missing cells as null and rows in file order.

    Files are split over tasks, also where quoted cells hold line breaks; ``multi_line=False`` says that none does and
    saves the look for them.
    """
    if multi_line:
        return csv.with_null_tokens(records.read_records(spark, path, order="ingest_seq"))
    return csv.with_null_tokens(csv.with_file_order(csv.read_csv(spark, path)))


def run_clean(
    spark: SparkSession,
    path: str | list[str],
    tables: ParquetTables | JdbcTables,
    multi_line: bool = True,
) -> DataFrame:
    """Fill the orders table from CSV; returns its report, counted on the written table."""
    raw = raw_orders(spark, path, multi_line)
    replace_orders(cleaning.clean_orders(raw), tables)
    return cleaning.clean_report(raw, tables.read(spark, ORDERS_TABLE))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Clean an orders CSV")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True, help="folder of the table")
    parser.add_argument("--single-line", action="store_true", help="no line breaks inside quotes: do not look for them")
    args = parser.parse_args(argv)
    spark = build_session("orderloom clean orders")
    row = run_clean(spark, args.input, ParquetTables(args.output), not args.single_line).first()
    print(f"read {row['n_in']:,}, kept {row['n_kept']:,}, rejected {row['n_rejected']:,}")


if __name__ == "__main__":
    main()
