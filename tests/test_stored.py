"""Stored pages and stored steps: what their scans read, and what they leave behind."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F

from orderloom import session
from orderloom.operators import paging
from orderloom.sources import commits
from orderloom.sources.tables import ParquetTables


def plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    made = ParquetTables(str(tmp_path_factory.mktemp("tables")))
    rows = spark.range(5000, numPartitions=6).selectExpr("id * 7919 % 5000 as k", "cast(id as string) as name")
    made.replace_pages(rows, "t", [F.col("k").desc()])
    return made


def test_stored_pages(spark, tables):
    pages = tables.pages(spark, "t")
    assert pages.total == 5000
    for number, size in [(1, 20), (250, 20), (251, 20), (17, 100), (50, 100)]:
        first = (number - 1) * size
        got = [r["k"] for r in pages.page(number, size).data.collect()]
        assert got == list(range(4999, -1, -1))[first : first + size]
    assert pages.page(1).data.columns == ["k", "name"]


def test_a_stored_page_is_a_pushed_range_without_a_sort(spark, tables, capsys):
    text = plan(tables.pages(spark, "t").page(3, 20).data, capsys)
    pushed = re.search(r"PushedFilters: \[(.*)\]", text)[1]
    assert "GreaterThanOrEqual(row_number,41)" in pushed and "LessThanOrEqual(row_number,60)" in pushed
    assert "Exchange" not in text and not re.search(r"\bSort\b", text) and "TakeOrderedAndProject" in text


def test_files_of_stored_pages_hold_ranges(spark, tables):
    rows = commits.read(spark, f"{tables.base}/t.pages").groupBy(F.input_file_name().alias("f"))
    ranges = sorted((r["a"], r["b"], r["n"]) for r in rows.agg(F.min("row_number").alias("a"), F.max("row_number").alias("b"), F.count("*").alias("n")).collect())
    assert all(b - a + 1 == n for a, b, n in ranges) and ranges[0][0] == 1 and ranges[-1][1] == 5000
    assert all(x[1] + 1 == y[0] for x, y in zip(ranges, ranges[1:]))


def test_pages_are_replaced(spark, tmp_path):
    tables = ParquetTables(str(tmp_path))
    for n in (30, 0, 7):
        tables.replace_pages(spark.range(n), "t")
        pages = tables.pages(spark, "t")
        assert (pages.total, [r["id"] for r in pages.page(1, 10).data.collect()]) == (n, list(range(min(n, 10))))


def test_a_stored_frame_is_a_pruned_scan(spark, capsys):
    df = session.stored(spark.range(10).selectExpr("id", "id % 3 as k", "'x' as text", "null as nothing"))
    text = plan(df.groupBy("k").count(), capsys)
    assert "Scan parquet" in text and re.search(r"ReadSchema: struct<k:bigint>", text)
    assert df.dtypes == [("id", "bigint"), ("k", "bigint"), ("text", "string"), ("nothing", "void")]
    assert df.where("nothing is null").count() == 10
    assert session.stored(spark.range(0)).count() == 0


def test_scratch_goes_with_the_job(spark):
    folder = session.shared_folder(spark)
    kept = session.stored(spark.range(3))
    before = set(os.listdir(folder))
    with pytest.raises(ValueError), session.scratch(spark):
        session.stored(spark.range(5))
        with session.scratch(spark):
            session.stored(spark.range(6))
            assert len(set(os.listdir(folder)) - before) == 2
        assert len(set(os.listdir(folder)) - before) == 1
        raise ValueError
    assert set(os.listdir(folder)) == before and kept.count() == 3
