"""Hot orders by the sketches kept with a raw day."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F, types as T

from orderloom.operators import enrich, quality, skew
from orderloom.plans import daily_run
from orderloom.sources import commits, daily
from tests.test_sources import DAY1, config, write_sources


def splits(hot: skew.HotKeys) -> dict:
    return {r[hot.key]: {s: r[f"splits_{s}"] for s in hot.sides} for r in hot.table.collect()} if hot.table else {}


@pytest.mark.parametrize("key", ["id % 1000", "if(id % 3 = 0, 7, id)", "if(id % 2 = 0, 'a', cast(id as string))"])
def test_kept_sketches_find_the_same_keys(spark, key):
    a = spark.range(20_000, numPartitions=5).selectExpr(f"{key} as k")
    b = spark.range(3000).selectExpr("cast(id as string) as k" if "string" in key else "id as k")
    kind = a.schema["k"].dataType
    kept = skew.kept_hot_keys({"a": skew.key_sketches(a, "k"), "b": skew.key_sketches(b, "k")}, "k", kind)
    assert splits(kept) == splits(skew.hot_keys({"a": a, "b": b}, "k"))


def test_sketches_of_parts_add_up(spark):
    whole = spark.range(20_000).selectExpr("if(id % 3 = 0, 7, id) as k", "id % 4 as part")
    parts = [skew.key_sketches(whole.where(F.col("part") == p), "k") for p in range(4)]
    kept = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    assert splits(skew.kept_hot_keys({"a": kept}, "k", T.LongType())) == splits(skew.hot_keys({"a": whole}, "k"))
    assert splits(skew.kept_hot_keys({"a": skew.key_sketches(whole.where("false"), "k")}, "k", T.LongType())) == {}


def test_a_day_is_joined_without_a_look_for_hot_orders(spark, tmp_path, monkeypatch):
    write_sources(tmp_path)
    cfg = config(tmp_path)
    daily_run.ingest(spark, cfg, DAY1)

    def looked(*_):
        raise AssertionError("inputs are scanned for hot orders")

    with monkeypatch.context() as patch:
        patch.setattr(skew, "hot_keys", looked)
        daily_run.refine(spark, cfg, DAY1)
    assert daily.read_day(spark, cfg.silver, "orders_enriched", DAY1).count() == 5


def test_a_day_without_sketches_is_searched(spark, tmp_path, capsys):
    write_sources(tmp_path)
    cfg = config(tmp_path)
    daily_run.ingest(spark, cfg, DAY1)
    folder = commits.Folder(spark, daily.day_path(cfg.raw, "reviews.keys", DAY1))
    folder.remove(folder.names())
    daily_run.refine(spark, cfg, DAY1)
    assert daily.read_day(spark, cfg.silver, "orders_enriched", DAY1).count() == 5


def test_each_input_is_scanned_once(spark, tmp_path, capsys):
    write_sources(tmp_path)
    cfg = config(tmp_path)
    daily_run.ingest(spark, cfg, DAY1)
    raw = {name: daily.read_day(spark, cfg.raw, name, DAY1) for name in daily_run.SOURCES}
    hot = daily_run._hot_orders(spark, cfg, raw, DAY1)
    sides = [quality.valid(raw[name], name) for name in ("order_items", "orders", "reviews")]
    capsys.readouterr()
    enrich.orders_enriched(*sides, hot=hot).explain()
    assert capsys.readouterr().out.count("FileScan parquet") == 3
