
from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from orderloom.functions import text, typing  # noqa: E402
from orderloom.operators import cleaning, enrich, marts, paging, quality, ranking, views  # noqa: E402
from orderloom.plans import clean_orders as clean_plan, daily_run as daily_plan  # noqa: E402
from orderloom.session import configure, partitions_for, scratch_path, stored, table_bytes  # noqa: E402
from orderloom.sources import bucketed, commits, csv, daily, records, tpch  # noqa: E402
from orderloom.sources.tables import ORDERS_TABLE, ParquetTables, replace_orders  # noqa: E402

try:  # the text operators are an optional part
    import corpus_pipeline
    from orderloom.llm import queries as text_queries
except ImportError:
    corpus_pipeline = text_queries = None

RUN_DATE = date(2024, 1, 15)
Query = Callable[[SparkSession, str], DataFrame]


def _zone_free(df: DataFrame) -> DataFrame:
    """Times without a zone, as the oracle has them."""
    times = [c for c, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times})


def _valid(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Valid items, orders and reviews."""
    sources = {"order_items": tpch.items, "orders": tpch.orders, "reviews": tpch.reviews}
    return [quality.valid(read(spark, sf), name) for name, read in sources.items()]


def _seller_facts(spark, sf):
    return enrich.seller_facts(*_valid(spark, sf))


def _order_facts(spark, sf):
    return enrich.order_facts(*_valid(spark, sf))


# --- inputs and rules ---------------------------------------------------------


def typed_inputs(spark, sf):
    cells = tpch.text_inputs(spark, sf).withColumnsRenamed(
        {"score": "review_score", "price_txt": "price", "ts_txt": "order_purchase_timestamp"}
    )
    typed = quality.typed_reviews(cells)
    return typed.withColumns(
        {
            "price": typing.amount(cells, "price"),
            "order_purchase_timestamp": typing.timestamp(cells, "order_purchase_timestamp"),
        }
    )


def items_valid(spark, sf):
    return quality.valid(tpch.items(spark, sf), "order_items")


def orders_valid(spark, sf):
    return quality.valid(tpch.orders(spark, sf), "orders")


def reviews_valid(spark, sf):
    return quality.valid(tpch.reviews(spark, sf), "reviews")


def quality_funnel(spark, sf):
    return quality.quality_funnel(tpch.items(spark, sf), tpch.reviews(spark, sf), tpch.orders(spark, sf))


# --- enriched rows, rankings, marts ---------------------------------------------


def orders_enriched(spark, sf):
    return enrich.orders_enriched(*_valid(spark, sf))


def orders_enriched_hot(spark, sf):
    """One order has many of the items, another one many of the reviews."""
    sides = tpch.hot_items(spark, sf), tpch.orders(spark, sf), tpch.hot_reviews(spark, sf)
    names = ("order_items", "orders", "reviews")
    return enrich.orders_enriched(*(quality.valid(df, name) for df, name in zip(sides, names)))


def seller_ranking(spark, sf):
    return marts.seller_ranking(_seller_facts(spark, sf))


def seller_ranking_bucketed(spark, sf):
    """From tables kept in buckets of their order, which meet without a shuffle."""
    sources = {"items": tpch.items, "orders": tpch.orders, "reviews": tpch.reviews}
    kept = [bucketed.keep(read(spark, sf), name, enrich.KEY) for name, read in sources.items()]
    names = ("order_items", "orders", "reviews")
    sides = [quality.valid(df, name) for df, name in zip(kept, names)]
    return marts.seller_ranking(enrich.seller_facts(*sides))


def item_ranking_ties(spark, sf):
    """Items by freight, a whole number below 10: thousands share a rank."""
    items = quality.valid(tpch.items(spark, sf), "order_items").select("order_id", "order_item_id", "freight_value")
    return ranking.rank_descending(items, "freight_value", "freight_rank")


def monthly_stats(spark, sf):
    return marts.monthly_stats(_order_facts(spark, sf))


def dm_order_status_performance(spark, sf):
    mart = marts.status_performance(_order_facts(spark, sf))
    return views.in_mart_order(mart, "dm_order_status_performance")


def dm_seller_performance(spark, sf):
    return marts.seller_mart(seller_ranking(spark, sf))


def dm_monthly_revenue(spark, sf):
    return views.in_mart_order(marts.month_mart(monthly_stats(spark, sf)), "dm_monthly_revenue")


def dm_review_distribution(spark, sf):
    mart = marts.review_distribution(_order_facts(spark, sf))
    return views.in_mart_order(mart, "dm_review_distribution")


# --- pages and reports over the marts, stored where they are read twice ------------------------------------------


def _paged(name: str, page: int, where=None, **options) -> Query:
    def query(spark, sf):
        condition = where() if where else None
        got = paging.page(
            stored(globals()[name](spark, sf)), page, order=paging.mart_order(name), where=condition, **options
        )
        return got.data.withColumn("total", F.lit(got.total).cast("bigint"))

    return query


def pages_cover_table(spark, sf):
    name = "dm_seller_performance"
    return paging.all_pages(dm_seller_performance(spark, sf), paging.mart_order(name))


def pages_default_order(spark, sf):
    """Items in pages of 7, in the default order, whose first column is not unique."""
    items = tpch.items(spark, sf).select("freight_value", "seller_id", "order_id", "order_item_id", "price")
    return paging.all_pages(items, page_size=7)


def page_sellers_stored(spark, sf):
    """A page of a mart whose pages are kept with it."""
    tables, name = ParquetTables(scratch_path(spark, "marts")), "dm_seller_performance"
    tables.replace_pages(dm_seller_performance(spark, sf), name, paging.mart_order(name))
    got = tables.pages(spark, name).page(2)
    return got.data.withColumn("total", F.lit(got.total).cast("bigint"))


def page_items_stored(spark, sf):
    """A page deep in a stored table, in the default order."""
    tables = ParquetTables(scratch_path(spark, "tables"))
    items = tpch.items(spark, sf).select("freight_value", "seller_id", "order_id", "order_item_id", "price")
    tables.replace_pages(items, "items")
    pages = tables.pages(spark, "items")
    got = pages.page(pages.total // 70, 50)
    return got.data.withColumn("total", F.lit(got.total).cast("bigint"))


def top_sellers(spark, sf):
    return views.top_sellers(dm_seller_performance(spark, sf))


def seller_scatter(spark, sf):
    return views.seller_scatter(dm_seller_performance(spark, sf))


def seller_scatter_first(spark, sf):
    """Fewer sellers than there are."""
    return views.seller_scatter(dm_seller_performance(spark, sf), 30)


def status_share(spark, sf):
    return views.status_share(stored(dm_order_status_performance(spark, sf)))


def score_histogram(spark, sf):
    return views.score_histogram(dm_review_distribution(spark, sf))


def status_score_matrix(spark, sf):
    return views.status_score_matrix(dm_review_distribution(spark, sf))


def status_score_matrix_gaps(spark, sf):
    """With a status that lacks scores, and a score that most statuses lack."""
    mart = dm_review_distribution(spark, sf)
    gaps = (F.col("order_status").startswith("d") & F.col("review_score").isin(2, 4)) | (
        ~F.col("order_status").startswith("d") & (F.col("review_score") == 5)
    )
    return views.status_score_matrix(mart.where(~gaps))


def revenue_kpis(spark, sf):
    return views.revenue_kpis(dm_monthly_revenue(spark, sf))


def chart_series(spark, sf):
    facts = stored(_order_facts(spark, sf))
    months = stored(marts.month_mart(marts.monthly_stats(facts)))
    return views.chart_series(months, marts.status_performance(facts))


def month_display(spark, sf):
    return views.month_display(dm_monthly_revenue(spark, sf))


# --- cleaning branch ----------------------------------------------------------------


def orders_clean(spark, sf):
    return cleaning.clean_orders(tpch.raw_orders(spark, sf))


def clean_report(spark, sf):
    return cleaning.clean_report(tpch.raw_orders(spark, sf), orders_clean(spark, sf))


def orders_clean_few_dates(spark, sf):
    """Input with one of the five dates; the result has all of its columns."""
    return cleaning.clean_orders(tpch.raw_orders(spark, sf).drop(*cleaning.DATE_COLUMNS[1:]))


def orders_clean_table(spark, sf):
    tables = ParquetTables(scratch_path(spark, "tables"))
    replace_orders(orders_clean(spark, sf), tables)
    return tables.read(spark, ORDERS_TABLE)


def csv_clean_report(spark, sf):
    # Second copies go to files that sort after those of the first ones.
    base, raw = scratch_path(spark, "orders.csv"), tpch.raw_orders(spark, sf)
    paths = [f"{base}/{n}" for n in (0, 1)]
    for n, path in enumerate(paths):
        csv.write_csv(raw.where(F.col("ingest_seq") == n).drop("ingest_seq"), path)
    return clean_plan.run_clean(spark, paths, ParquetTables(scratch_path(spark, "tables")))


def csv_null_tokens(spark, sf):
    """Statuses, many of them spelt as a missing value, written as CSV and read by the cleaning job."""
    tokens = F.array(*map(F.lit, text.NULL_TOKENS))
    which = (F.col("order_id") % 25).cast("int")
    orders = tpch.orders(spark, sf).select("order_id", "order_status")
    spelt = F.when(which < len(text.NULL_TOKENS), F.get(tokens, which)).otherwise(F.col("order_status"))
    path = scratch_path(spark, "orders.csv")
    csv.write_csv(orders.withColumn("order_status", spelt), path)
    rows = clean_plan.raw_orders(spark, path)
    return rows.select(F.col("order_id").cast("bigint").alias("order_id"), "order_status")


# --- files, days and whole runs ----------------------------------------------------------


def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "orders.csv")
    csv.write_csv(tpch.orders(spark, sf), path)
    back = csv.read_csv(spark, path)
    back = back.withColumns({c: F.col(c).try_cast("bigint") for c in ("order_id", "customer_id")})
    return quality.valid(back, "orders")


def csv_line_breaks(spark, sf):
    """Texts with line breaks, quotes and commas, written as CSV and read back in splits."""
    path = scratch_path(spark, "texts.csv")
    csv.write_csv(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text"), path)
    return records.read_records(spark, path, types={"doc_id": "bigint"})


def planned_partitions(spark, sf):
    """Shuffle partitions of 64 KB for each input."""
    sources = {"order_items": tpch.items, "orders": tpch.orders, "reviews": tpch.reviews}
    planned = [(name, partitions_for(table_bytes(read(spark, sf)), 1 << 16)) for name, read in sources.items()]
    return spark.createDataFrame(planned, "name string, n_partitions bigint")


def raw_roundtrip(spark, sf):
    base, items = scratch_path(spark, "raw"), tpch.items(spark, sf)
    first, second = RUN_DATE, RUN_DATE.replace(day=16)
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    daily.write_day(items, base, "order_items", first)
    daily.write_day(items.where("order_item_id > 1"), base, "order_items", second, files)
    daily.write_day(items, base, "order_items", second, files)
    return daily.read_day(spark, base, "order_items", second)


def empty_day_roundtrip(spark, sf):
    """Two days written, the second one again with nothing."""
    base, items = scratch_path(spark, "raw"), tpch.items(spark, sf)
    days = RUN_DATE, RUN_DATE.replace(day=16)
    for day in days:
        daily.write_day(items, base, "order_items", day)
    daily.write_day(items.where("false"), base, "order_items", days[1])
    counts = [
        daily.read_day(spark, base, "order_items", day).agg(F.count("*").alias("n_rows")).select(F.lit(day.day).alias("day"), "n_rows")
        for day in days
    ]
    return counts[0].unionByName(counts[1])


def _write_csv_sources(spark, sf, **others) -> dict[str, str]:
    sources = {"order_items": tpch.items, "reviews": tpch.reviews, "orders": tpch.orders} | others
    paths = {name: scratch_path(spark, f"{name}.csv") for name in sources}
    for name, read in sources.items():
        csv.write_csv(read(spark, sf), paths[name])
    return paths


def _config(spark, sf, **others) -> daily_plan.Config:
    return daily_plan.Config(
        _write_csv_sources(spark, sf, **others),
        scratch_path(spark, "raw"),
        scratch_path(spark, "silver"),
        ParquetTables(scratch_path(spark, "marts")),
    )


def silver_roundtrip(spark, sf):
    cfg = _config(spark, sf)
    daily_plan.ingest(spark, cfg, RUN_DATE)
    daily_plan.refine(spark, cfg, RUN_DATE)
    counts = [
        daily.read_day(spark, cfg.silver, name, RUN_DATE)
        .agg(F.count("*").alias("n_rows"))
        .select(F.lit(name).alias("name"), "n_rows")
        for name in daily_plan.SILVER
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def silver_hot(spark, sf):
    """A silver day of hot orders, which the sketches kept with the raw day name."""
    cfg = _config(spark, sf, order_items=tpch.hot_items, reviews=tpch.hot_reviews)
    daily_plan.ingest(spark, cfg, RUN_DATE)
    daily_plan.refine(spark, cfg, RUN_DATE)
    rows = daily.read_day(spark, cfg.silver, "orders_enriched", RUN_DATE)
    return rows.groupBy("order_status", "review_score").agg(F.count("*").alias("n_rows"))


def mart_roundtrip(spark, sf):
    tables = ParquetTables(scratch_path(spark, "marts"))
    tables.replace(dm_seller_performance(spark, sf), "dm_seller_performance")
    return tables.read(spark, "dm_seller_performance")


def daily_run(spark, sf):
    cfg = _config(spark, sf)
    daily_plan.run_day(spark, cfg, RUN_DATE)
    return cfg.marts.read(spark, "dm_order_status_performance")


def command_line_run(spark, sf):
    """A run started with command-line arguments, in the session there is."""
    cfg = _config(spark, sf)
    files = {"items": cfg.csv["order_items"], "reviews": cfg.csv["reviews"], "orders": cfg.csv["orders"]}
    paths = files | {"raw": cfg.raw, "silver": cfg.silver, "marts": cfg.marts.base, "date": RUN_DATE.isoformat()}
    daily_plan.main([part for name, value in paths.items() for part in (f"--{name}", value)])
    return cfg.marts.read(spark, "dm_order_status_performance")


def daily_rerun(spark, sf):
    """A run, then a second one with other decimals: what is kept and what is made again."""
    cfg = _config(spark, sf)
    daily_plan.run_day(spark, cfg, RUN_DATE)
    paths = {n: daily.day_path(cfg.raw, n, RUN_DATE) for n in daily_plan.SOURCES}
    paths |= {n: daily.day_path(cfg.silver, n, RUN_DATE) for n in daily_plan.SILVER}
    paths |= {n: f"{cfg.marts.base}/{n}" for n in daily_plan.MARTS}
    before = {name: commits.version(spark, path) for name, path in paths.items()}
    daily_plan.run_day(spark, replace(cfg, scale=4), RUN_DATE)
    rows = [
        commits.read(spark, path).agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("name"), F.lit(commits.version(spark, path) == before[name]).alias("kept"), "n_rows"
        )
        for name, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def daily_run_report(spark, sf):
    cfg = _config(spark, sf)
    daily_plan.run_day(spark, cfg, RUN_DATE)
    return daily_plan.run_report(spark, cfg, RUN_DATE)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        typed_inputs, items_valid, reviews_valid, orders_valid, quality_funnel,
        orders_enriched, orders_enriched_hot, seller_ranking, seller_ranking_bucketed, item_ranking_ties, monthly_stats,
        dm_order_status_performance, dm_seller_performance, dm_monthly_revenue, dm_review_distribution,
        pages_cover_table, pages_default_order, page_sellers_stored, page_items_stored, top_sellers, seller_scatter,
        seller_scatter_first, status_share, score_histogram, status_score_matrix, status_score_matrix_gaps, revenue_kpis,
        chart_series, month_display,
        orders_clean, orders_clean_few_dates, clean_report, orders_clean_table, csv_clean_report, csv_null_tokens,
        csv_roundtrip, csv_line_breaks, planned_partitions, raw_roundtrip, empty_day_roundtrip, silver_roundtrip, silver_hot, mart_roundtrip,
        daily_run, daily_rerun, command_line_run, daily_run_report,
    )
} | {
    "page_sellers": _paged("dm_seller_performance", 2),
    "page_sellers_deep": _paged("dm_seller_performance", 3),
    "page_months": _paged("dm_monthly_revenue", 2),
    "page_statuses": _paged("dm_order_status_performance", 1),
    "page_reviews": _paged("dm_review_distribution", 1, where=lambda: F.col("review_score") >= 4),
}


def _registered(query: Query) -> Query:
    return lambda spark, sf: _zone_free(query(configure(spark), sf))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the top sellers by revenue at sf 0.001."""
    return queries()["top_sellers"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One entry per operator; each takes the session and the folder of the tables."""
    found = dict(QUERIES)
    if text_queries:
        found |= text_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return {name: _registered(query) for name, query in found.items()}


def oracle_sql() -> dict[str, str]:
    """The same answers in SQL."""
    found = dict(oracle_queries.SQL)
    if text_queries:
        found |= text_queries.SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
