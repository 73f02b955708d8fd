"""Replacements that are stopped at any step leave the old rows or the new ones."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import DataFrameWriter

from orderloom.sources import commits, daily
from orderloom.sources.tables import ParquetTables

DAY = date(2024, 1, 15)


class Killed(BaseException):
    """Stops a replacement without any clean-up, as a lost driver does."""


def killed_before(monkeypatch, cls, name: str, after: int = 0):
    """The method stops the job when it is called for the ``after + 1``-th time."""
    calls, own = [], getattr(cls, name)

    def method(self, *args, **options):
        calls.append(name)
        if len(calls) > after:
            raise Killed
        return own(self, *args, **options)

    monkeypatch.setattr(cls, name, method)


def ids(df) -> list[int]:
    return sorted(r["id"] for r in df.collect())


OLD, NEW = list(range(3)), list(range(5))
# Which step fails, at which call of it, and what is read afterwards.
STEPS = [
    (DataFrameWriter, "parquet", 0, OLD),
    (commits.Folder, "commit", 0, OLD),
    (commits.Folder, "remove", 0, NEW),
    (commits.Folder, "remove", 1, NEW),
]


@pytest.mark.parametrize("cls, name, after, want", STEPS)
@pytest.mark.parametrize("kind", ["table", "day"])
def test_a_killed_replacement(spark, tmp_path, monkeypatch, cls, name, after, want, kind):
    tables = ParquetTables(str(tmp_path))

    def replace(n: int) -> None:
        if kind == "table":
            tables.replace(spark.range(n), "t", lambda rows: None)
        else:
            daily.write_day(spark.range(n), str(tmp_path), "t", DAY)

    def read():
        return tables.read(spark, "t") if kind == "table" else daily.read_day(spark, str(tmp_path), "t", DAY)

    replace(3)
    with monkeypatch.context() as patch:
        killed_before(patch, cls, name, after)
        with pytest.raises(Killed):
            replace(5)
    assert ids(read()) == want
    replace(4)
    assert ids(read()) == list(range(4))
    folder = commits.Folder(spark, f"{tmp_path}/t" if kind == "table" else daily.day_path(str(tmp_path), "t", DAY))
    write = folder.last().write
    assert all(write in name for name in folder.data()) and len(folder.names("_commit-*")) == 1
    assert ids(spark.read.parquet(folder.path)) == list(range(4))


def test_a_check_that_is_killed(spark, tmp_path):
    tables = ParquetTables(str(tmp_path))
    tables.replace(spark.range(3), "t")

    def kill(rows):
        assert ids(rows) == NEW
        raise Killed

    with pytest.raises(Killed):
        tables.replace(spark.range(5), "t", kill)
    assert ids(tables.read(spark, "t")) == OLD


def test_a_failed_write_leaves_the_day(spark, tmp_path):
    base = str(tmp_path)
    daily.write_day(spark.range(3), base, "t", DAY)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        daily.write_day(spark.range(100, numPartitions=4).selectExpr("id", "1 / (id - 99) as x"), base, "t", DAY)
    assert ids(daily.read_day(spark, base, "t", DAY)) == OLD
    folder = commits.Folder(spark, daily.day_path(base, "t", DAY))
    assert all(folder.last().write in name for name in folder.data())


def test_a_first_write_that_is_killed_leaves_nothing_to_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    with monkeypatch.context() as patch:
        killed_before(patch, commits.Folder, "commit", 1)
        with pytest.raises(Killed):
            commits.replace(spark.range(3), path)
    with pytest.raises(commits.NeverWrittenError):
        commits.read(spark, path)
    commits.replace(spark.range(5), path)
    assert ids(commits.read(spark, path)) == NEW


def test_files_without_a_commit(spark, tmp_path, monkeypatch):
    """A folder of another writer is read as it is, and replaced in one step as well."""
    path = str(tmp_path / "t")
    spark.range(2).write.parquet(path)
    spark.range(2, 3).write.mode("append").parquet(path)
    assert ids(commits.read(spark, path)) == OLD and commits.facts(spark, path) == {}
    with monkeypatch.context() as patch:
        killed_before(patch, commits.Folder, "commit", 1)
        with pytest.raises(Killed):
            commits.replace(spark.range(5), path)
    assert ids(commits.read(spark, path)) == OLD
    commits.replace(spark.range(5), path, facts={"n": 5})
    assert ids(commits.read(spark, path)) == NEW and commits.facts(spark, path) == {"n": 5}


def test_of_two_replacements_at_once_one_fails(spark, tmp_path):
    path = str(tmp_path / "t")
    commits.replace(spark.range(3), path)
    with pytest.raises(commits.ConflictError):
        commits.replace(spark.range(4), path, check=lambda rows: commits.replace(spark.range(5), path))
    assert ids(commits.read(spark, path)) == NEW
    assert len(commits.Folder(spark, path).names("_commit-*")) == 1


def test_rows_read_while_they_are_replaced(spark, tmp_path):
    """A table may be made from itself."""
    path = str(tmp_path / "t")
    commits.replace(spark.range(3), path)
    commits.replace(commits.read(spark, path).selectExpr("id + 10 as id"), path)
    assert ids(commits.read(spark, path)) == [10, 11, 12]
