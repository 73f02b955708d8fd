"""Runs that failed go on where they stopped; counts come from footers."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest

from orderloom import session
from orderloom.operators import marts
from orderloom.plans import daily_run
from orderloom.sources import commits, daily
from orderloom.sources.tables import ParquetTables
from tests.test_sources import DAY1, DAY2, config, write_sources


def versions(spark, cfg) -> dict[str, str | None]:
    paths = {name: daily.day_path(cfg.raw, name, DAY1) for name in daily_run.SOURCES}
    paths |= {name: daily.day_path(cfg.silver, name, DAY1) for name in daily_run.SILVER}
    paths |= {name: f"{cfg.marts.base}/{name}" for name in daily_run.MARTS}
    return {name: commits.version(spark, path) for name, path in paths.items()}


def rows(spark, cfg) -> dict[str, list[str]]:
    return {name: sorted(map(str, cfg.marts.read(spark, name).collect())) for name in daily_run.MARTS}


# The function that fails, and the tables that are written by then.
FAILURES = {
    "seller_ranking": (*daily_run.SOURCES, "orders_enriched"),
    "month_mart": (*daily_run.SOURCES, *daily_run.SILVER, "dm_order_status_performance", "dm_seller_performance"),
}


@pytest.mark.parametrize("step", FAILURES)
def test_a_failed_run_goes_on_where_it_stopped(spark, tmp_path, monkeypatch, step):
    write_sources(tmp_path)
    cfg = config(tmp_path)

    def fail(*_):
        raise OSError(step)

    with monkeypatch.context() as patch:
        patch.setattr(marts, step, fail)
        with pytest.raises(OSError, match=step):
            daily_run.run_day(spark, cfg, DAY1)
    before = versions(spark, cfg)
    assert {name for name, version in before.items() if version} == set(FAILURES[step])
    daily_run.run_day(spark, cfg, DAY1)
    after = versions(spark, cfg)
    assert all(after[name] == version for name, version in before.items() if version) and all(after.values())
    whole = replace(cfg, raw=f"{tmp_path}/r2", silver=f"{tmp_path}/s2", marts=ParquetTables(f"{tmp_path}/m2"))
    daily_run.run_day(spark, whole, DAY1)
    assert rows(spark, cfg) == rows(spark, whole)


def test_only_what_changed_is_made_again(spark, tmp_path):
    write_sources(tmp_path)
    cfg = config(tmp_path)
    daily_run.run_day(spark, cfg, DAY1)
    first = versions(spark, cfg)
    daily_run.run_day(spark, cfg, DAY1)
    assert versions(spark, cfg) == first

    with open(tmp_path / "reviews.csv", "a") as file:
        file.write("b,3,late\n")
    daily_run.run_day(spark, cfg, DAY1)
    second = versions(spark, cfg)
    assert {name for name in first if first[name] == second[name]} == {"order_items", "orders"}
    assert [r["review_score"] for r in cfg.marts.read(spark, "dm_review_distribution").where("order_status = 'created'").collect()] == [3]

    daily_run.run_day(spark, replace(cfg, scale=2), DAY1)
    third = versions(spark, cfg)
    assert {name for name in second if second[name] == third[name]} == {*daily_run.SOURCES, "orders_enriched"}

    daily_run.run_day(spark, replace(cfg, scale=2, again=True), DAY1)
    assert not set(third.values()) & set(versions(spark, cfg).values())


def test_marts_follow_the_day(spark, tmp_path):
    """A run of another day replaces the marts, and so does going back."""
    write_sources(tmp_path)
    cfg = config(tmp_path)
    daily_run.run_day(spark, cfg, DAY1)
    one = rows(spark, cfg)
    (tmp_path / "items.csv").write_text("order_id,seller_id,price,freight_value\na,s1,10.0,1.0\n")
    daily_run.run_day(spark, cfg, DAY2)
    two = rows(spark, cfg)
    assert one != two
    daily_run.publish(spark, cfg, DAY1)
    assert rows(spark, cfg) == one


def test_days_without_commits_are_always_made(spark, tmp_path):
    write_sources(tmp_path)
    cfg = config(tmp_path)
    daily_run.ingest(spark, cfg, DAY1)
    for name in daily_run.SOURCES:
        folder = commits.Folder(spark, daily.day_path(cfg.raw, name, DAY1))
        folder.remove(folder.names("_commit-*"))
    daily_run.refine(spark, cfg, DAY1)
    first = versions(spark, cfg)["orders_enriched"]
    daily_run.refine(spark, cfg, DAY1)
    assert versions(spark, cfg)["orders_enriched"] != first


def test_a_run_leaves_no_scratch_and_keeps_pages(spark, tmp_path):
    write_sources(tmp_path)
    cfg = replace(config(tmp_path), pages=True)
    before = set(os.listdir(session.shared_folder(spark)))
    daily_run.run_day(spark, cfg, DAY1)
    assert set(os.listdir(session.shared_folder(spark))) == before
    page = cfg.marts.pages(spark, "dm_seller_performance").page(1, 5)
    assert (page.total, [r["seller_id"] for r in page.data.collect()]) == (2, ["s2", "s1"])


def test_counts_are_read_from_footers(spark, tmp_path, capsys):
    write_sources(tmp_path)
    cfg = config(tmp_path)
    daily_run.run_day(spark, cfg, DAY1)
    report = daily_run.run_report(spark, cfg, DAY1)
    capsys.readouterr()
    report.explain("formatted")
    assert capsys.readouterr().out.count("PushedAggregation: [COUNT(*)]") == len(daily_run.SILVER) + len(daily_run.MARTS)
    counted = {(r["stage"], r["name"]): r["n_rows"] for r in report.collect()}
    for name in daily_run.SILVER:
        assert counted["silver", name] == len(daily.read_day(spark, cfg.silver, name, DAY1).collect())
    with pytest.raises(ValueError), session.counted_from_footers(spark):
        raise ValueError
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
