"""Order items, reviews and orders derived from TPC-H-like tables.

The source tables are clean and have no reviews or delivery dates. Bad rows,
nulls, repeated reviews and second copies are put in by key arithmetic, so every
rule of the package has something to reject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


# An order whose items cost more than 1e16, and the orders that are hot on one side.
HUGE_ORDER, HOT_ITEMS, HOT_REVIEWS = 7, 33, 34


def _view(spark: SparkSession, sf_dir: str, table: str, *select: str, where: str = "true") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").where(where).selectExpr(*select)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(
        spark, sf_dir, "lineitem",
        "case when l_partkey % 97 = 0 then null else l_orderkey end as order_id",
        "l_linenumber as order_item_id",
        "l_suppkey as seller_id",
        f"""case when l_quantity = 1 then 0D when l_quantity = 2 then null when l_quantity = 3 then l_extendedprice + 0.125D
                 when l_orderkey = {HUGE_ORDER} then 2e16D else cast(l_extendedprice as double) end as price""",
        "rint(l_tax * 100) - 1 as freight_value",
    )


def hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All items, those on the first two lines of any order moved to one order."""
    moved = F.when(F.col("order_item_id") <= 2, HOT_ITEMS).otherwise(F.col("order_id"))
    return items(spark, sf_dir).withColumn("order_id", moved)


def hot_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reviews, those with an even id moved to one order."""
    moved = F.when(F.col("review_id") % 2 == 0, HOT_REVIEWS).otherwise(F.col("order_id"))
    return reviews(spark, sf_dir).withColumn("order_id", moved)


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(
        spark, sf_dir, "events",
        "event_id as review_id",
        "case when event_id % 3 = 2 then event_id - 1 else event_id end as order_id",
        "case when event_type = 'error' then null else cast(event_id % 7 as int) end as review_score",
    )


def _plus_days(days: str) -> str:
    return f"o_orderdate + make_dt_interval(cast({days} as int))"


_PURCHASE = "case when o_orderkey % 101 = 0 then null else o_orderdate end"
_ORDER_KEYS = [
    "o_orderkey as order_id",
    "case when o_custkey % 53 = 0 then null else o_custkey end as customer_id",
    """case when o_custkey % 41 = 0 then null
            when o_custkey % 37 = 0 then 'lost'
            when o_orderstatus = 'F' then case when o_custkey % 2 = 0 then ' Delivered ' else 'delivered' end
            when o_orderstatus = 'O' then 'SHIPPED'
            else ' processing' end as order_status""",
]
_DELIVERED = f"case when o_orderstatus = 'P' then null else {_plus_days('o_custkey % 40')} end"


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(
        spark, sf_dir, "orders",
        *_ORDER_KEYS,
        f"{_PURCHASE} as order_purchase_timestamp",
        f"{_DELIVERED} as order_delivered_customer_date",
        f"{_plus_days('20')} as order_estimated_delivery_date",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text for the cleaning branch, with second copies that must lose.

    Statuses are wrapped in a tab and a newline; every seventh purchase time is in
    a format the table does not accept.
    """
    def text(time: str) -> str:
        return f"date_format({time}, 'yyyy-MM-dd HH:mm:ss')"

    purchase = f"""case when o_orderkey % 7 = 0 then date_format(o_orderdate, 'dd/MM/yyyy')
                        else {text(_PURCHASE)} end"""
    dates = [
        f"{purchase} as order_purchase_timestamp",
        f"{text(_PURCHASE)} as order_approved_at",
        f"{text(_plus_days('o_custkey % 20'))} as order_delivered_carrier_date",
        f"{text(_DELIVERED)} as order_delivered_customer_date",
        f"{text(_plus_days('20'))} as order_estimated_delivery_date",
    ]
    key, customer, status = _ORDER_KEYS
    wrapped = f"concat(char(9), {status.removesuffix(' as order_status')}, char(10)) as order_status"
    first = _view(spark, sf_dir, "orders", key, customer, wrapped, *dates, "0 as ingest_seq")
    second = _view(
        spark, sf_dir, "orders", key, customer, "'canceled' as order_status", *dates, "1 as ingest_seq",
        where="o_orderkey % 200 = 0",
    )
    return first.unionByName(second)


def text_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores, prices and times as text, with cells that do not parse."""
    return _view(
        spark, sf_dir, "events",
        "event_id",
        """case when event_id % 11 = 0 then 'abc' when event_id % 13 = 0 then ''
                when event_id % 17 = 0 then '4.7' else cast(event_id % 7 as string) end as score""",
        "case when event_id % 10 = 0 then 'n/a' else cast(value as string) end as price_txt",
        "case when event_id % 19 = 0 then 'bad' else date_format(ts, 'yyyy-MM-dd HH:mm:ss') end as ts_txt",
    )
