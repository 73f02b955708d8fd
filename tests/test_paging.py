"""Pages and reports over small marts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderloom.operators import paging, views
from orderloom.session import stored


@pytest.fixture(scope="module")
def sellers(spark):
    df = spark.range(45).selectExpr(
        "id as seller_id", "id % 4 as nb_orders", "100D - cast(id / 2 as int) as total_revenue",
        "cast(null as double) as avg_review_score", "cast(id / 2 as int) * 2 + 1 as revenue_rank",
    )
    return stored(df)


ORDER = "dm_seller_performance"


def test_pages(sellers):
    seen, pages = [], paging.Pages(sellers, paging.mart_order(ORDER))
    for number, size in [(1, 20), (2, 20), (3, 5), (4, 0)]:
        page = pages.page(number, 20)
        ids = [r["seller_id"] for r in page.data.collect()]
        assert (page.total, len(ids)) == (45, size)
        seen += ids
    assert seen == list(range(45))


def test_page_defaults(sellers):
    page = paging.page(sellers)
    assert (page.page, page.page_size) == (1, 20)
    assert [r["seller_id"] for r in page.data.collect()] == list(range(20))


def test_pages_in_the_default_order_hold_each_row_once(spark):
    """The first column repeats, and some rows are equal altogether."""
    df = spark.range(1000, numPartitions=6).selectExpr("id % 3 as a", "id % 50 as b", "cast(null as string) as c")
    pages = paging.Pages(df)
    got = [tuple(r) for n in range(1, 12) for r in pages.page(n, 100).data.collect()]
    assert got == sorted((i % 3, i % 50, None) for i in range(1000))


def test_page_filter_applies_to_rows_and_total(sellers):
    page = paging.page(sellers, 2, 5, where=F.col("nb_orders") == 3)
    assert (page.total, [r["seller_id"] for r in page.data.collect()]) == (11, [23, 27, 31, 35, 39])


@pytest.mark.parametrize("page, size", [(0, 20), (1, 0), (1, 101), (-1, 20)])
def test_bad_page_arguments(sellers, page, size):
    with pytest.raises(ValueError):
        paging.page(sellers, page, size)


def test_row_numbers_over_many_partitions(spark):
    df = spark.range(5000, numPartitions=7).selectExpr("id as k", "id % 10 as v")
    got = paging.number_rows(df, [F.col("v").desc(), F.col("k").asc()]).collect()
    by_number = sorted(got, key=lambda r: r["row_number"])
    assert [r["row_number"] for r in by_number] == list(range(1, 5001))
    assert [(r["v"], r["k"]) for r in by_number] == sorted(((r["v"], r["k"]) for r in got), key=lambda t: (-t[0], t[1]))


def test_all_pages_hold_each_row_once(sellers):
    got = paging.all_pages(sellers, paging.mart_order(ORDER), 10).collect()
    assert sorted((r["page"], r["seller_id"]) for r in got) == [(i // 10 + 1, i) for i in range(45)]


def test_unknown_mart():
    with pytest.raises(KeyError):
        paging.mart_order("dm_other")


def test_top_sellers(sellers):
    assert [r["seller_id"] for r in views.top_sellers(sellers, 5).collect()] == [0, 1, 2, 3, 4]
    assert views.top_sellers(sellers).count() == 20
    assert views.seller_scatter(sellers).count() == 45
    for n in (4, 51):
        with pytest.raises(ValueError):
            views.top_sellers(sellers, n)


def test_status_share_and_matrix(spark):
    statuses = spark.createDataFrame([("a", 3), ("b", 1)], "order_status string, nb_orders bigint")
    assert {tuple(r) for r in views.status_share(statuses).collect()} == {("a", 0.75), ("b", 0.25)}
    reviews = spark.createDataFrame([(1, "a", 2), (5, "a", 4), (5, "b", 1)], "review_score int, order_status string, nb_orders bigint")
    assert {tuple(r) for r in views.status_score_matrix(reviews).collect()} == {("a", 2, 0, 0, 0, 4), ("b", 0, 0, 0, 0, 1)}
    assert {tuple(r) for r in views.score_histogram(reviews).collect()} == {(1, 2), (5, 5)}


def test_month_mart_is_shown_in_order_with_the_null_month_last(spark):
    months = spark.createDataFrame(
        [(None, 1, 1.0, 1.0), ("2017-02-01 00:00:00", 1, 0.2, 1.3), ("2017-01-01 00:00:00", 2, 0.1, 1.1)],
        "order_month string, nb_orders bigint, monthly_revenue double, cumulative_revenue double",
    )
    shown = [r["order_month"] for r in views.month_display(months).collect()]
    assert shown[0] < shown[1] and shown[2] is None
    assert tuple(views.revenue_kpis(months).first()) == (1.3, 4)
