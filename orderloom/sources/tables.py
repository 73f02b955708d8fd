"""Stores for the marts: Parquet folders or a relational database over JDBC."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession

from ..operators import cleaning, paging
from ..session import stored
from . import commits
from .commits import Check


@dataclass(frozen=True)
class ParquetTables:
    base: str

    def replace(self, df: DataFrame, table: str, check: Check | None = None, made_from: str | None = None) -> None:
        """Write beside the rows of the table, check what was written, then let it count in their place.

        A job that fails or is stopped anywhere leaves the table as it was, or replaced; see ``commits``.
        """
        commits.replace(df, f"{self.base}/{table}", check, facts={commits.MADE_FROM: made_from})

    def is_made_from(self, spark: SparkSession, table: str, made_from: str | None) -> bool:
        return commits.is_made_from(spark, f"{self.base}/{table}", made_from)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return commits.read(spark, f"{self.base}/{table}")

    def replace_pages(self, df: DataFrame, table: str, order: list[Column] | None = None) -> None:
        """Keep the pages of a table next to it; see ``paging.store``."""
        paging.store(df, f"{self.base}/{table}.pages", order)

    def pages(self, spark: SparkSession, table: str) -> paging.StoredPages:
        return paging.StoredPages(spark, f"{self.base}/{table}.pages")


@dataclass(frozen=True)
class JdbcTables:
    """Tables of a database. Its driver jar must be on the class path.

    ``connections`` bounds the tasks that write at once. ``column_types`` maps a
    table to column types the database should use in place of its defaults.
    ``partitioning`` maps a table to the reader options that split its scan
    (partitionColumn, lowerBound, upperBound, numPartitions).
    """

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    batch_size: int = 10_000
    connections: int = 8
    truncate: bool = False
    column_types: dict[str, str] = field(default_factory=dict)
    partitioning: dict[str, dict[str, str]] = field(default_factory=dict)

    @classmethod
    def from_environment(cls, **options) -> JdbcTables:
        """Connection settings from JDBC_URL, JDBC_USER, JDBC_PASSWORD and JDBC_DRIVER."""
        names = {"user": "JDBC_USER", "password": "JDBC_PASSWORD", "driver": "JDBC_DRIVER"}
        properties = {key: os.environ[name] for key, name in names.items() if name in os.environ}
        return cls(os.environ["JDBC_URL"], properties, **options)

    def is_made_from(self, spark: SparkSession, table: str, made_from: str | None) -> bool:
        """A database keeps no word of it."""
        return False

    def replace(self, df: DataFrame, table: str, check: Check | None = None, made_from: str | None = None) -> None:
        if check:
            df = stored(df)  # what is checked is what is written
            check(df)
        options = {
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.connections),
            "truncate": str(self.truncate).lower(),
        }
        if table in self.column_types:
            options["createTableColumnTypes"] = self.column_types[table]
        df.write.mode("overwrite").options(**options).jdbc(self.url, table, properties=self.properties)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        reader = spark.read.options(**self.partitioning.get(table, {}))
        return reader.jdbc(self.url, table, properties=self.properties)


ORDERS_TABLE = "orders"


def replace_orders(df: DataFrame, tables: ParquetTables | JdbcTables) -> None:
    """Replace the cleaned orders table, or raise and leave it if the rows break its contract."""
    tables.replace(df, ORDERS_TABLE, lambda rows: cleaning.check_contract(rows, "order_id", ["customer_id", "order_status"]))
