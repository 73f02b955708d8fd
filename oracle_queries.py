"""DuckDB SQL that answers each registered query independently, over the same tables."""

from __future__ import annotations

# Doubles and decimals are cast by way of text, which rounds once; the direct casts may round twice.
TIME = "'%Y-%m-%d %H:%M:%S'"

ITEMS = """items AS (
  SELECT CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE l_orderkey END AS order_id,
         l_linenumber AS order_item_id,
         l_suppkey AS seller_id,
         CASE WHEN l_quantity = 1 THEN 0 WHEN l_quantity = 2 THEN NULL
              WHEN l_quantity = 3 THEN CAST(l_extendedprice AS DOUBLE) + CAST(0.125 AS DOUBLE)
              WHEN l_orderkey = 7 THEN CAST(2e16 AS DOUBLE)
              ELSE CAST(l_extendedprice AS DOUBLE) END AS price,
         CAST(round(l_tax * 100) - 1 AS DOUBLE) AS freight_value
  FROM lineitem)"""

REVIEWS = """reviews AS (
  SELECT event_id AS review_id,
         CASE WHEN event_id % 3 = 2 THEN event_id - 1 ELSE event_id END AS order_id,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id % 7 AS INT) END AS review_score
  FROM events)"""

ORDERS = """orders_a AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_custkey % 53 = 0 THEN NULL ELSE o_custkey END AS customer_id,
         CASE WHEN o_custkey % 41 = 0 THEN NULL WHEN o_custkey % 37 = 0 THEN 'lost'
              WHEN o_orderstatus = 'F' THEN CASE WHEN o_custkey % 2 = 0 THEN ' Delivered ' ELSE 'delivered' END
              WHEN o_orderstatus = 'O' THEN 'SHIPPED' ELSE ' processing' END AS order_status,
         CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderdate END AS order_purchase_timestamp,
         CASE WHEN o_orderstatus = 'P' THEN NULL
              ELSE o_orderdate + to_days(CAST(o_custkey % 40 AS INT)) END AS order_delivered_customer_date,
         o_orderdate + to_days(CAST(20 AS INT)) AS order_estimated_delivery_date
  FROM orders)"""

VALID = f"""{ITEMS}, {REVIEWS}, {ORDERS},
items_v AS (SELECT * FROM items WHERE order_id IS NOT NULL AND price > 0 AND freight_value >= 0),
reviews_v AS (SELECT * FROM reviews WHERE review_score BETWEEN 1 AND 5),
orders_v AS (SELECT * FROM orders_a WHERE order_status IS NOT NULL)"""

ENRICHED = f"""{VALID},
enriched AS (
  SELECT i.order_id, i.order_item_id, i.seller_id, i.price, i.freight_value,
         o.customer_id, o.order_status, o.order_purchase_timestamp,
         o.order_delivered_customer_date, o.order_estimated_delivery_date, r.review_score,
         i.price + i.freight_value AS total_amount,
         CAST(date_diff('day', CAST(o.order_estimated_delivery_date AS DATE),
                               CAST(o.order_delivered_customer_date AS DATE)) AS INTEGER) AS delivery_delay_days
  FROM items_v i JOIN orders_v o ON o.order_id = i.order_id
  LEFT JOIN reviews_v r ON r.order_id = i.order_id)"""

SELLERS = f"""{ENRICHED},
seller_sums AS (
  SELECT seller_id, COUNT(order_id) AS nb_orders, SUM(CAST(CAST(price AS VARCHAR) AS DECIMAL(38,6))) AS tr, AVG(review_score) AS avg_review_score
  FROM enriched GROUP BY seller_id),
sellers AS (
  SELECT seller_id, nb_orders, CAST(CAST(tr AS VARCHAR) AS DOUBLE) AS total_revenue, avg_review_score,
         CAST(rank() OVER (ORDER BY tr DESC NULLS LAST) AS INTEGER) AS revenue_rank
  FROM seller_sums)"""

MONTHS = f"""{ENRICHED},
month_sums AS (
  SELECT date_trunc('month', order_purchase_timestamp) AS order_month, COUNT(order_id) AS nb_orders,
         SUM(CAST(CAST(total_amount AS VARCHAR) AS DECIMAL(38,6))) AS mr
  FROM enriched GROUP BY 1),
months_ts AS (
  SELECT CAST(order_month AS TIMESTAMP) AS order_month, nb_orders, CAST(CAST(mr AS VARCHAR) AS DOUBLE) AS monthly_revenue,
         CAST(CAST(SUM(mr) OVER (ORDER BY order_month NULLS FIRST) AS VARCHAR) AS DOUBLE) AS cumulative_revenue
  FROM month_sums),
months AS (
  SELECT strftime(order_month, {TIME}) AS order_month, nb_orders, monthly_revenue, cumulative_revenue
  FROM months_ts)"""

_STATUS_SELECT = """
  SELECT order_status, COUNT(order_id) AS nb_orders,
         CAST(CAST(SUM(CAST(CAST(total_amount AS VARCHAR) AS DECIMAL(38,6))) AS VARCHAR) AS DOUBLE) / COUNT(order_id) AS avg_amount,
         AVG(review_score) AS avg_review_score, AVG(delivery_delay_days) AS avg_delay_days,
         CAST(CAST(SUM(CAST(CAST(total_amount AS VARCHAR) AS DECIMAL(38,6))) AS VARCHAR) AS DOUBLE) AS total_revenue
  FROM enriched GROUP BY order_status"""
STATUSES = f"{ENRICHED}, statuses AS ({_STATUS_SELECT})"

REVIEW_MART = f"""{ENRICHED},
review_mart AS (
  SELECT review_score, order_status, COUNT(order_id) AS nb_orders, AVG(delivery_delay_days) AS avg_delay_days
  FROM enriched WHERE review_score IS NOT NULL GROUP BY review_score, order_status)"""

_RAW_DATES = f"""
         CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
              ELSE strftime(CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderdate END, {TIME})
              END AS order_purchase_timestamp,
         strftime(CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_orderdate END, {TIME}) AS order_approved_at,
         strftime(o_orderdate + to_days(CAST(o_custkey % 20 AS INT)), {TIME}) AS order_delivered_carrier_date,
         strftime(CASE WHEN o_orderstatus = 'P' THEN NULL
              ELSE o_orderdate + to_days(CAST(o_custkey % 40 AS INT)) END, {TIME}) AS order_delivered_customer_date,
         strftime(o_orderdate + to_days(CAST(20 AS INT)), {TIME}) AS order_estimated_delivery_date"""
_CUSTOMER = "CASE WHEN o_custkey % 53 = 0 THEN NULL ELSE o_custkey END AS customer_id"


def _canonical(column: str) -> str:
    return f"strftime(try_strptime({column}, {TIME}), {TIME}) AS {column}"


CLEAN = f"""raw_orders AS (
  SELECT o_orderkey AS order_id, {_CUSTOMER},
         chr(9) || CASE WHEN o_custkey % 41 = 0 THEN NULL WHEN o_custkey % 37 = 0 THEN 'lost'
              WHEN o_orderstatus = 'F' THEN CASE WHEN o_custkey % 2 = 0 THEN ' Delivered ' ELSE 'delivered' END
              WHEN o_orderstatus = 'O' THEN 'SHIPPED' ELSE ' processing' END || chr(10) AS order_status,
         {_RAW_DATES}, 0 AS ingest_seq
  FROM orders
  UNION ALL
  SELECT o_orderkey, {_CUSTOMER}, 'canceled', {_RAW_DATES}, 1
  FROM orders WHERE o_orderkey % 200 = 0),
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ingest_seq) AS nth FROM raw_orders) t
  WHERE nth = 1),
stripped AS (
  SELECT * REPLACE (lower(regexp_replace(order_status, '^\\s+|\\s+$', '', 'g')) AS order_status)
  FROM firsts WHERE order_id IS NOT NULL AND customer_id IS NOT NULL),
cleaned AS (
  SELECT order_id, customer_id, order_status,
         {_canonical("order_purchase_timestamp")}, {_canonical("order_approved_at")},
         {_canonical("order_delivered_carrier_date")}, {_canonical("order_delivered_customer_date")},
         {_canonical("order_estimated_delivery_date")}
  FROM stripped
  WHERE order_status IN ('delivered','shipped','canceled','processing','invoiced','unavailable','approved','created'))"""

_ITEM_DOUBLES = "* REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value)"


def _page(ctes: str, table: str, order: str, page: int, size: int = 20, where: str = "TRUE") -> str:
    return f"""WITH {ctes}
SELECT *, (SELECT COUNT(*) FROM {table} WHERE {where}) AS total FROM {table} WHERE {where}
ORDER BY {order} LIMIT {size} OFFSET {(page - 1) * size}"""


def _rule(source: str, rule: str, table: str, before: str, after: str) -> str:
    return (
        f"SELECT '{source}' AS source, '{rule}' AS rule, "
        f"COUNT(*) FILTER (WHERE {before}) AS n_in, COUNT(*) FILTER (WHERE {after}) AS n_kept FROM {table}"
    )


_R1 = "order_id IS NOT NULL"
_R2 = f"{_R1} AND price > 0"
_R3 = f"{_R2} AND freight_value >= 0"

_ENRICHED_HOT = (
    ENRICHED.replace("FROM items WHERE", "FROM items_h WHERE")
    .replace("FROM reviews WHERE", "FROM reviews_h WHERE")
    .replace("items_v AS", """items_h AS (
  SELECT * REPLACE (CASE WHEN order_item_id <= 2 THEN 33 ELSE order_id END AS order_id) FROM items),
reviews_h AS (SELECT * REPLACE (CASE WHEN review_id % 2 = 0 THEN 34 ELSE order_id END AS order_id) FROM reviews),
items_v AS""")
)

SQL: dict[str, str] = {
    "typed_inputs": f"""WITH t AS (
  SELECT event_id,
         CASE WHEN event_id % 11 = 0 THEN 'abc' WHEN event_id % 13 = 0 THEN ''
              WHEN event_id % 17 = 0 THEN '4.7' ELSE CAST(event_id % 7 AS VARCHAR) END AS score,
         CASE WHEN event_id % 10 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS price_txt,
         CASE WHEN event_id % 19 = 0 THEN 'bad' ELSE strftime(ts, {TIME}) END AS ts_txt
  FROM events)
SELECT event_id, TRY_CAST(trunc(TRY_CAST(score AS DOUBLE)) AS INTEGER) AS review_score,
       TRY_CAST(price_txt AS DOUBLE) AS price,
       try_strptime(ts_txt, {TIME}) AS order_purchase_timestamp
FROM t""",
    "items_valid": f"WITH {VALID} SELECT {_ITEM_DOUBLES} FROM items_v",
    "reviews_valid": f"WITH {VALID} SELECT * FROM reviews_v",
    "orders_valid": f"WITH {VALID} SELECT * FROM orders_v",
    "quality_funnel": f"WITH {VALID}\n" + "\nUNION ALL ".join([
        _rule("order_items", "R1", "items", "TRUE", _R1),
        _rule("order_items", "R2", "items", _R1, _R2),
        _rule("order_items", "R3", "items", _R2, _R3),
        _rule("reviews", "R4", "reviews", "TRUE", "review_score BETWEEN 1 AND 5"),
        _rule("orders", "R5", "orders_a", "TRUE", "order_status IS NOT NULL"),
    ]),
    "orders_enriched": f"""WITH {ENRICHED} SELECT * REPLACE (CAST(price AS DOUBLE) AS price,
  CAST(freight_value AS DOUBLE) AS freight_value, CAST(total_amount AS DOUBLE) AS total_amount) FROM enriched""",
    "orders_enriched_hot": f"WITH {_ENRICHED_HOT} SELECT * FROM enriched",
    "silver_hot": f"WITH {_ENRICHED_HOT} SELECT order_status, review_score, COUNT(*) AS n_rows FROM enriched GROUP BY ALL",
    "item_ranking_ties": f"""WITH {VALID} SELECT order_id, order_item_id, freight_value,
  CAST(rank() OVER (ORDER BY freight_value DESC) AS INTEGER) AS freight_rank FROM items_v""",
    "pages_default_order": f"""WITH {ITEMS} SELECT freight_value, seller_id, order_id, order_item_id, price, CAST(
  (row_number() OVER (ORDER BY freight_value NULLS LAST, seller_id NULLS LAST, order_id NULLS LAST,
    order_item_id NULLS LAST, price NULLS LAST) - 1) // 7 + 1 AS INTEGER) AS page FROM items""",
    "orders_clean_few_dates": f"""WITH {CLEAN} SELECT order_id, customer_id, order_status, order_purchase_timestamp,
  CAST(NULL AS VARCHAR) AS order_approved_at, CAST(NULL AS VARCHAR) AS order_delivered_carrier_date,
  CAST(NULL AS VARCHAR) AS order_delivered_customer_date, CAST(NULL AS VARCHAR) AS order_estimated_delivery_date
FROM cleaned""",
    "empty_day_roundtrip": "SELECT 15 AS day, COUNT(*) AS n_rows FROM lineitem UNION ALL SELECT 16, 0",
    "seller_ranking": f"WITH {SELLERS} SELECT * FROM sellers",
    "seller_ranking_bucketed": f"WITH {SELLERS} SELECT * FROM sellers",
    "monthly_stats": f"WITH {MONTHS} SELECT * FROM months_ts",
    "dm_order_status_performance": f"WITH {STATUSES} SELECT * FROM statuses",
    "dm_seller_performance": f"WITH {SELLERS} SELECT * FROM sellers",
    "dm_monthly_revenue": f"WITH {MONTHS} SELECT * FROM months",
    "dm_review_distribution": f"WITH {REVIEW_MART} SELECT * FROM review_mart",
    "page_sellers": _page(SELLERS, "sellers", "revenue_rank, seller_id", 2),
    "page_sellers_deep": _page(SELLERS, "sellers", "revenue_rank, seller_id", 3),
    "page_months": _page(MONTHS, "months", "order_month NULLS LAST", 2),
    "page_statuses": _page(STATUSES, "statuses", "nb_orders DESC, order_status", 1),
    "page_reviews": _page(REVIEW_MART, "review_mart", "review_score, order_status", 1, where="review_score >= 4"),
    "pages_cover_table": f"""WITH {SELLERS} SELECT *, CAST(
  (row_number() OVER (ORDER BY revenue_rank, seller_id) - 1) // 100 + 1 AS INTEGER) AS page FROM sellers""",
    "page_sellers_stored": _page(SELLERS, "sellers", "revenue_rank, seller_id", 2),
    "page_items_stored": f"""WITH {ITEMS}, n AS (SELECT COUNT(*) AS total FROM items), numbered AS (
  SELECT freight_value, seller_id, order_id, order_item_id, price, row_number() OVER (ORDER BY freight_value NULLS LAST,
    seller_id NULLS LAST, order_id NULLS LAST, order_item_id NULLS LAST, price NULLS LAST) AS place FROM items)
SELECT numbered.* EXCLUDE (place), total FROM numbered, n
WHERE place > (total // 70 - 1) * 50 AND place <= total // 70 * 50""",
    "top_sellers": f"WITH {SELLERS} SELECT * FROM sellers ORDER BY revenue_rank, seller_id LIMIT 20",
    "seller_scatter": f"""WITH {SELLERS} SELECT total_revenue, avg_review_score, nb_orders
FROM sellers ORDER BY revenue_rank, seller_id LIMIT 200""",
    "seller_scatter_first": f"""WITH {SELLERS} SELECT total_revenue, avg_review_score, nb_orders
FROM sellers ORDER BY revenue_rank, seller_id LIMIT 30""",
    "status_share": f"""WITH {STATUSES}
SELECT order_status, CAST(nb_orders AS DOUBLE) / (SELECT SUM(nb_orders) FROM statuses) AS share FROM statuses""",
    "score_histogram": f"""WITH {REVIEW_MART}
SELECT review_score, CAST(SUM(nb_orders) AS BIGINT) AS nb_orders FROM review_mart GROUP BY review_score""",
    "status_score_matrix": f"WITH {REVIEW_MART} SELECT order_status, " + ", ".join(
        f"CAST(COALESCE(SUM(nb_orders) FILTER (WHERE review_score = {s}), 0) AS BIGINT) AS score_{s}"
        for s in range(1, 6)
    ) + " FROM review_mart GROUP BY order_status",
    "status_score_matrix_gaps": f"WITH {REVIEW_MART} SELECT order_status, " + ", ".join(
        f"CAST(COALESCE(SUM(nb_orders) FILTER (WHERE review_score = {s}), 0) AS BIGINT) AS score_{s}"
        for s in range(1, 6)
    ) + """ FROM review_mart WHERE CASE WHEN order_status LIKE 'd%' THEN review_score NOT IN (2, 4)
    ELSE review_score <> 5 END GROUP BY order_status""",
    "revenue_kpis": f"""WITH {MONTHS}
SELECT CAST(CAST(SUM(mr) AS VARCHAR) AS DOUBLE) AS total_revenue, CAST(SUM(nb_orders) AS BIGINT) AS nb_orders FROM month_sums""",
    "chart_series": f"""WITH {MONTHS}, statuses AS ({_STATUS_SELECT})
SELECT 'monthly_revenue' AS series, order_month AS label, monthly_revenue AS value FROM months
UNION ALL SELECT 'cumulative_revenue', order_month, cumulative_revenue FROM months
UNION ALL SELECT 'status_revenue', order_status, total_revenue FROM statuses""",
    "month_display": f"WITH {MONTHS} SELECT * FROM months_ts ORDER BY order_month NULLS LAST",
    "orders_clean": f"WITH {CLEAN} SELECT * FROM cleaned",
    "clean_report": f"""WITH {CLEAN}, n AS (
  SELECT (SELECT COUNT(*) FROM raw_orders) AS n_in, (SELECT COUNT(*) FROM cleaned) AS n_kept)
SELECT n_in, n_kept, n_in - n_kept AS n_rejected FROM n""",
    "orders_clean_table": f"WITH {CLEAN} SELECT * FROM cleaned",
    "csv_roundtrip": f"WITH {VALID} SELECT * FROM orders_v",
    "csv_clean_report": f"""WITH {CLEAN}, n AS (
  SELECT (SELECT COUNT(*) FROM raw_orders) AS n_in, (SELECT COUNT(*) FROM cleaned) AS n_kept)
SELECT n_in, n_kept, n_in - n_kept AS n_rejected FROM n""",
    "csv_null_tokens": f"""WITH {VALID} SELECT order_id, CASE WHEN order_id % 25 < 19 THEN NULL ELSE order_status END AS order_status
FROM orders_a""",
    "csv_line_breaks": "SELECT doc_id, text FROM documents",
    "planned_partitions": f"""WITH {VALID}, n AS (
  SELECT 'order_items' AS name, COUNT(*) * (8 + 8 + 4 + 8 + 8 + 8) AS n_bytes FROM items
  UNION ALL SELECT 'orders', COUNT(*) * (8 + 8 + 8 + 20 + 8 + 8 + 8) FROM orders_a
  UNION ALL SELECT 'reviews', COUNT(*) * (8 + 8 + 8 + 4) FROM reviews)
SELECT name, CAST((n_bytes + 65535) // 65536 AS BIGINT) AS n_partitions FROM n""",
    "raw_roundtrip": f"WITH {ITEMS} SELECT {_ITEM_DOUBLES} FROM items",
    "silver_roundtrip": f"""WITH {SELLERS}
SELECT 'orders_enriched' AS name, (SELECT COUNT(*) FROM enriched) AS n_rows
UNION ALL SELECT 'seller_ranking', (SELECT COUNT(*) FROM sellers)
UNION ALL SELECT 'monthly_stats', (SELECT COUNT(DISTINCT COALESCE(
  CAST(date_trunc('month', order_purchase_timestamp) AS VARCHAR), 'none')) FROM enriched)""",
    "mart_roundtrip": f"WITH {SELLERS} SELECT * FROM sellers",
    "command_line_run": f"WITH {STATUSES} SELECT * FROM statuses",
    "daily_run": f"WITH {STATUSES} SELECT * FROM statuses",
    "daily_rerun": f"""WITH {SELLERS}, n AS (
  SELECT (SELECT COUNT(*) FROM enriched) AS joined, (SELECT COUNT(*) FROM sellers) AS sellers,
         (SELECT COUNT(*) FROM (SELECT DISTINCT date_trunc('month', order_purchase_timestamp) FROM enriched) m) AS months,
         (SELECT COUNT(DISTINCT order_status) FROM enriched) AS statuses,
         (SELECT COUNT(*) FROM (SELECT DISTINCT review_score, order_status FROM enriched
                                WHERE review_score IS NOT NULL) s) AS scores)
SELECT 'order_items' AS name, TRUE AS kept, COUNT(*) AS n_rows FROM items
UNION ALL SELECT 'reviews', TRUE, COUNT(*) FROM reviews
UNION ALL SELECT 'orders', TRUE, COUNT(*) FROM orders_a
UNION ALL SELECT 'orders_enriched', TRUE, joined FROM n
UNION ALL SELECT 'seller_ranking', FALSE, sellers FROM n
UNION ALL SELECT 'monthly_stats', FALSE, months FROM n
UNION ALL SELECT 'dm_order_status_performance', FALSE, statuses FROM n
UNION ALL SELECT 'dm_seller_performance', FALSE, sellers FROM n
UNION ALL SELECT 'dm_monthly_revenue', FALSE, months FROM n
UNION ALL SELECT 'dm_review_distribution', FALSE, scores FROM n""",
    "daily_run_report": f"""WITH {SELLERS}, n AS (
  SELECT (SELECT COUNT(*) FROM enriched) AS joined, (SELECT COUNT(*) FROM sellers) AS sellers,
         (SELECT COUNT(*) FROM (SELECT DISTINCT date_trunc('month', order_purchase_timestamp) FROM enriched) m) AS months,
         (SELECT COUNT(DISTINCT order_status) FROM enriched) AS statuses,
         (SELECT COUNT(*) FROM (SELECT DISTINCT review_score, order_status FROM enriched
                                WHERE review_score IS NOT NULL) s) AS scores)
SELECT 'raw' AS stage, 'order_items' AS name, COUNT(*) AS n_rows FROM items
UNION ALL SELECT 'raw', 'reviews', COUNT(*) FROM reviews
UNION ALL SELECT 'raw', 'orders', COUNT(*) FROM orders_a
UNION ALL SELECT 'rule', 'R1', COUNT(*) FROM items WHERE {_R1}
UNION ALL SELECT 'rule', 'R2', COUNT(*) FROM items WHERE {_R2}
UNION ALL SELECT 'rule', 'R3', COUNT(*) FROM items WHERE {_R3}
UNION ALL SELECT 'rule', 'R4', COUNT(*) FROM reviews_v
UNION ALL SELECT 'rule', 'R5', COUNT(*) FROM orders_v
UNION ALL SELECT 'silver', 'orders_enriched', joined FROM n
UNION ALL SELECT 'silver', 'seller_ranking', sellers FROM n
UNION ALL SELECT 'silver', 'monthly_stats', months FROM n
UNION ALL SELECT 'mart', 'dm_order_status_performance', statuses FROM n
UNION ALL SELECT 'mart', 'dm_seller_performance', sellers FROM n
UNION ALL SELECT 'mart', 'dm_monthly_revenue', months FROM n
UNION ALL SELECT 'mart', 'dm_review_distribution', scores FROM n""",
}
