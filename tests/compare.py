"""Exact comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

# Spark type name -> DuckDB type name
TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def difference(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if names, types and the multiset of rows are equal, else what differs."""
    expected = con.sql(sql)
    want_types = dict(zip(expected.columns, map(str, expected.types)))
    got_types = {name: TYPES.get(kind, kind) for name, kind in df.dtypes}
    if got_types != want_types:
        return f"schema {got_types} != {want_types}"
    names = sorted(got_types)
    order = [expected.columns.index(n) for n in names]
    want = Counter(tuple(row[i] for i in order) for row in expected.fetchall())
    got = Counter(tuple(row) for row in df.select(*names).collect())
    if got == want:
        return None
    return f"{sum(got.values())} rows != {sum(want.values())}; only Spark {list((got - want))[:2]}; only SQL {list((want - got))[:2]}"
