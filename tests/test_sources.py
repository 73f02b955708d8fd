"""CSV scans, day partitions, mart stores and whole runs."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest
from pyspark.sql import DataFrameReader, DataFrameWriter, functions as F, types as T
from pyspark.errors import AnalysisException

from orderloom import session
from orderloom.plans import daily_run
from orderloom.sources import csv, daily
from orderloom.sources.tables import JdbcTables, ParquetTables

DAY1, DAY2 = date(2024, 1, 15), date(2024, 1, 16)


def test_quoted_line_break(spark, tmp_path):
    path = str(tmp_path / "reviews.csv")
    (tmp_path / "reviews.csv").write_text('order_id,review_score,comment\na,5,"two\nlines ""quoted"""\n')
    (row,) = csv.read_csv(spark, path, multi_line=True).collect()
    assert row["comment"] == 'two\nlines "quoted"'
    assert csv.read_csv(spark, path).count() == 2


def test_csv_types(spark, tmp_path):
    path = str(tmp_path / "items.csv")
    (tmp_path / "items.csv").write_text("order_id,price,at\na,1.5,2017-10-02 10:56:33\n")
    assert [t for _, t in csv.read_csv(spark, path).dtypes] == ["string"] * 3
    assert [t for _, t in csv.read_csv(spark, path, infer=True).dtypes] == ["string", "double", "timestamp"]
    schema = T.StructType().add("order_id", "string").add("price", "double").add("at", "timestamp")
    assert csv.read_csv(spark, path, schema=schema).first()["price"] == 1.5


def test_csv_with_header_only(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("order_id,price\n")
    df = csv.read_csv(spark, str(tmp_path / "empty.csv"))
    assert (df.columns, df.count()) == (["order_id", "price"], 0)


def test_csv_write_keeps_edge_space(spark, tmp_path):
    df = spark.createDataFrame([(" a\t", 'say "x", y'), ("b\n", None)], "k string, v string")
    csv.write_csv(df, str(tmp_path / "out"))
    back = csv.read_csv(spark, str(tmp_path / "out"), multi_line=True)
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in df.collect()}


def test_a_day_is_replaced_by_nothing(spark, tmp_path):
    base = str(tmp_path)
    for rows in (5, 0):
        daily.write_day(spark.range(rows), base, "t", DAY1)
        daily.write_day(spark.range(3), base, "t", DAY2)
    assert daily.read_day(spark, base, "t", DAY1).count() == 0
    assert daily.read_day(spark, base, "t", DAY1).columns == ["id"]
    assert daily.read_day(spark, base, "t", DAY2).count() == 3


def test_types_by_name(spark, tmp_path):
    (tmp_path / "items.csv").write_text("order_id,price,note\n007,1.5,x\n008,bad,y\n")
    df = csv.read_csv(spark, str(tmp_path / "items.csv"), types={"price": "double"})
    assert df.dtypes == [("order_id", "string"), ("price", "double"), ("note", "string")]
    assert [tuple(r) for r in df.collect()] == [("007", 1.5, "x"), ("008", None, "y")]


def test_a_failed_replacement_leaves_the_table(spark, tmp_path):
    tables = ParquetTables(str(tmp_path))
    tables.replace(spark.range(3), "t")

    def refuse(rows):
        raise ValueError(rows.count())

    with pytest.raises(ValueError, match="5"):
        tables.replace(spark.range(5), "t", refuse)
    assert tables.read(spark, "t").count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_a_day_is_replaced_alone(spark, tmp_path):
    base = str(tmp_path)
    daily.write_day(spark.range(3), base, "t", DAY1)
    daily.write_day(spark.range(5), base, "t", DAY2)
    daily.write_day(spark.range(4), base, "t", DAY2, files=2)
    assert daily.read_day(spark, base, "t", DAY1).count() == 3
    assert daily.read_day(spark, base, "t", DAY2).count() == 4
    assert daily.read_day(spark, base, "t", DAY1).columns == ["id"]
    assert {tuple(r) for r in spark.read.parquet(f"{base}/t").select("year", "month", "day").distinct().collect()} == {
        (2024, 1, 15), (2024, 1, 16),
    }
    assert len(list((tmp_path / "t/year=2024/month=1/day=16").glob("*.parquet"))) == 2


def test_a_missing_day_is_an_error(spark, tmp_path):
    daily.write_day(spark.range(3), str(tmp_path), "t", DAY1)
    with pytest.raises(AnalysisException):
        daily.read_day(spark, str(tmp_path), "t", DAY2)


def test_jdbc_options(spark, monkeypatch):
    """The calls only: no database is started for a test."""
    calls = []
    monkeypatch.setattr(DataFrameWriter, "options", lambda self, **o: calls.append(o) or self)
    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, properties=None: calls.append((url, table, properties)))
    monkeypatch.setattr(DataFrameReader, "options", lambda self, **o: calls.append(o) or self)
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, properties=None: calls.append((url, table, properties)))
    tables = JdbcTables(
        "jdbc:x", {"user": "u"}, column_types={"t": "name VARCHAR(20)"},
        partitioning={"t": {"partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "3"}},
    )
    tables.replace(spark.range(1), "t")
    tables.replace(spark.range(1), "other")
    tables.read(spark, "t")
    assert calls[0] == {"batchsize": "10000", "numPartitions": "8", "truncate": "false", "createTableColumnTypes": "name VARCHAR(20)"}
    assert calls[1] == ("jdbc:x", "t", {"user": "u"})
    assert "createTableColumnTypes" not in calls[2]
    assert calls[4]["partitionColumn"] == "id"
    assert calls[5] == ("jdbc:x", "t", {"user": "u"})


def write_sources(folder):
    (folder / "items.csv").write_text("order_id,seller_id,price,freight_value,product_id\na,s1,10.0,1.0,p\na,s2,20.5,0,p\nb,s1,5,2,p\nx,s1,0,1,p\n,s1,9,1,p\n")
    (folder / "reviews.csv").write_text('order_id,review_score,comment\na,5,"good,\nvery"\na,4.0,\nb,9,bad score\n')
    (folder / "orders.csv").write_text(
        "order_id,order_status,order_purchase_timestamp,order_delivered_customer_date,order_estimated_delivery_date\n"
        "a,delivered,2017-01-05 10:00:00,2017-01-09 00:00:00,2017-01-08 23:00:00\n"
        "b,created,bad time,,2017-01-08 00:00:00\nc,,2017-01-05 10:00:00,,\n"
    )


def config(folder, tables=None):
    return daily_run.Config(
        {"order_items": str(folder / "items.csv"), "reviews": str(folder / "reviews.csv"), "orders": str(folder / "orders.csv")},
        str(folder / "raw"), str(folder / "silver"), tables or ParquetTables(str(folder / "marts")),
    )


def test_daily_run(spark, tmp_path):
    write_sources(tmp_path)
    cfg = config(tmp_path)
    for day in (DAY1, DAY2, DAY2):
        daily_run.run_day(spark, cfg, day)
    enriched = daily.read_day(spark, cfg.silver, "orders_enriched", DAY2)
    assert enriched.count() == 5 and "product_id" in enriched.columns
    assert daily.read_day(spark, cfg.silver, "orders_enriched", DAY1).count() == 5

    def mart(name):
        return sorted((tuple(r) for r in cfg.marts.read(spark, name).collect()), key=str)

    assert mart("dm_seller_performance") == [("s1", 3, 25.0, 4.5, 2), ("s2", 2, 41.0, 4.5, 1)]
    assert mart("dm_order_status_performance") == [
        ("created", 1, 7.0, None, None, 7.0), ("delivered", 4, 15.75, 4.5, 1.0, 63.0),
    ]
    assert mart("dm_monthly_revenue") == [("2017-01-01 00:00:00", 4, 63.0, 70.0), (None, 1, 7.0, 7.0)]
    assert mart("dm_review_distribution") == [(4, "delivered", 2, 1.0), (5, "delivered", 2, 1.0)]
    report = {(r["stage"], r["name"]): r["n_rows"] for r in daily_run.run_report(spark, cfg, DAY2).collect()}
    assert report[("raw", "reviews")] == 3 and report[("rule", "R3")] == 3 and report[("rule", "R4")] == 2
    assert report[("silver", "orders_enriched")] == 5 and report[("mart", "dm_review_distribution")] == 2


def test_typed_raw_layer(spark, tmp_path):
    """Types found or given while the CSV is read lead to the same marts."""
    write_sources(tmp_path)
    items = T.StructType().add("order_id", "string").add("seller_id", "string").add("price", "double")
    items = items.add("freight_value", "double").add("product_id", "string")
    found = None
    for n, options in enumerate([{}, {"infer": True}, {"schemas": {"order_items": items}}]):
        folder = tmp_path / str(n)
        folder.mkdir()
        cfg = replace(config(tmp_path), raw=str(folder / "raw"), silver=str(folder / "silver"), marts=ParquetTables(str(folder / "marts")), **options)
        daily_run.run_day(spark, cfg, DAY1)
        kind = dict(daily.read_day(spark, cfg.raw, "order_items", DAY1).dtypes)["price"]
        assert kind == "double"
        got = [sorted(map(str, cfg.marts.read(spark, m).collect())) for m in daily_run.MARTS]
        found = found or got
        assert got == found


def test_a_failed_stage_stops_the_run(spark, tmp_path):
    write_sources(tmp_path)
    (tmp_path / "orders.csv").unlink()
    with pytest.raises(AnalysisException):
        daily_run.run_day(spark, config(tmp_path), DAY1)
    assert not (tmp_path / "silver").exists()


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    write_sources(tmp_path)
    monkeypatch.setattr(daily_run, "build_session", lambda app: spark)
    where = [f"--{n}={tmp_path}/{n}.csv" for n in ("items", "reviews", "orders")]
    where += [f"--{n}={tmp_path}/{n}" for n in ("raw", "silver", "marts")]
    daily_run.main([*where, "--date=2024-01-15"])
    assert "dm_seller_performance" in capsys.readouterr().out
    monkeypatch.delenv("JDBC_URL", raising=False)
    with pytest.raises(KeyError, match="JDBC_URL"):
        daily_run.main([*where[:-1], "--date=2024-01-15"])
    monkeypatch.setenv("JDBC_URL", "jdbc:x")
    monkeypatch.setenv("JDBC_USER", "u")
    assert JdbcTables.from_environment() == JdbcTables("jdbc:x", {"user": "u"})


def test_shared_folder_comes_from_the_session(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_folder(spark) == folder.rstrip("/")
    assert session.scratch_path(spark, "t").startswith(folder)


def test_stored_cuts_the_lineage(spark, capsys):
    df = session.stored(spark.range(10).groupBy((F.col("id") % 3).alias("k")).count())
    df.explain()
    assert "Exchange" not in capsys.readouterr().out
    assert df.count() == 3
