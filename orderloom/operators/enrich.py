"""The join of items, orders and review scores, in full and in counted form.

The full form has one row per item and matching review. The counted form stops
before that fan-out: reviews of one order are counted per score, and the counts
go into the marts as weights, so no pair of item and review is ever built for
them. All inputs are valid rows (see ``quality.valid``).

``hot`` takes the hot orders if they are known (see ``skew.hot_keys``); left out,
they are looked for in the inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, typing
from . import skew

KEY = "order_id"
SCORES = (1, 2, 3, 4, 5)
PER_SCORE = [f"n_{s}" for s in SCORES]
# Sides on which each join may meet hot orders. The rows of the others are summed
# up per order before they move.
ROW_SIDES = ("items", "orders", "reviews")
SELLER_SIDES = ("items",)
ORDER_SIDES = ("orders",)
# Copies of one item row that are generated from one array.
BLOCK = 10_000


def total_amount() -> Column:
    return F.col("price") + F.col("freight_value")


def delay_days() -> Column:
    return dates.days_late("order_delivered_customer_date", "order_estimated_delivery_date")


def review_counts(reviews: DataFrame) -> DataFrame:
    """One row per reviewed order: reviews, sum of scores, reviews per score.

    Counted before the shuffle, so an order with very many reviews is one row per
    task by the time it moves. Columns a query does not use are not computed.
    """
    score = F.col("review_score")
    return (
        reviews.select(KEY, "review_score")
        .where(F.col(KEY).isNotNull() & score.isin(*SCORES))
        .groupBy(KEY)
        .agg(
            F.count("*").alias("n_scored"),
            F.sum(score).alias("score_sum"),
            *[F.count_if(score == s).alias(n) for s, n in zip(SCORES, PER_SCORE)],
        )
    )


def _unfolded(counts: DataFrame) -> DataFrame:
    """Review counts as rows of a score and up to ``BLOCK`` copies.

    At most one row per order, score and block, made before the join, so an item row
    carries neither counts nor arrays. A slice without any count keeps one row with
    no copies: its order does have reviews, in another slice.
    """
    given = F.filter(
        F.array(*[F.struct(F.lit(s).alias("score"), F.col(n).alias("copies")) for s, n in zip(SCORES, PER_SCORE)]),
        lambda r: r["copies"] > 0,
    )
    none = F.array(F.struct(F.lit(None).cast("int").alias("score"), F.lit(0).cast("bigint").alias("copies")))
    rest = [c for c in counts.columns if c not in PER_SCORE]
    rows = counts.select(*rest, F.inline(F.when(F.size(given) > 0, given).otherwise(none)))
    block = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.ceil(F.col("copies") / BLOCK), F.lit(1)) - 1))
    in_block = F.least(F.lit(BLOCK), F.col("copies") - F.col("_block") * BLOCK).cast("int")
    return rows.withColumn("_block", block).select(*rest, F.col("score").alias("_score"), in_block.alias("_copies"))


def orders_enriched(
    items: DataFrame, orders: DataFrame, reviews: DataFrame, hot: skew.HotKeys | None = None
) -> DataFrame:
    """Every item with its order, once per review of that order (once if it has none).

    Orders that occur twice and reviews that occur twice multiply the rows. Hot
    orders are split on whichever side they are hot, and the copies an order's
    reviews call for are generated in blocks on many tasks.
    """
    hot = hot.only(*ROW_SIDES) if hot else skew.hot_keys(dict(zip(ROW_SIDES, (items, orders, reviews))), KEY)
    counts = review_counts(reviews).select(KEY, *PER_SCORE)
    # Rows are copied to the review salts only once they are known to have an order.
    rows, copies = hot.only("items", "orders"), hot.only("reviews")
    ordered = rows.spread(items, "items").join(rows.spread(orders, "orders"), rows.join_on)
    unfolded = _unfolded(hot.spread(counts, "reviews", counts=PER_SCORE))
    joined = copies.spread(ordered).join(unfolded, hot.join_on, "left")
    if "reviews" in hot.sides:
        # An item without reviews was copied to every review salt: keep one.
        joined = joined.where((F.col("_copies") > 0) | F.col("_copies").isNull() & (F.col("salt_reviews") == 0))
    item_columns = [c for c in items.columns if c != KEY]
    order_columns = [c for c in orders.columns if c != KEY]
    return (
        joined.withColumn("review_score", F.explode(F.array_repeat("_score", F.coalesce("_copies", F.lit(1)))))
        .select(
            KEY,
            *item_columns,
            *order_columns,
            "review_score",
            total_amount().alias("total_amount"),
            delay_days().alias("delivery_delay_days"),
        )
    )


# --- counted form -------------------------------------------------------------
#
# A frame of facts has its group columns and
#   n_rows      how many enriched rows the row stands for
#   amount      the exact sum of the amount over those rows
#   n_scored    how many of those rows have a score
#   score_sum   the sum of their scores
#   n_1 .. n_5  how many of those rows have each score
SCORE_SUMS = ["n_scored", "score_sum", *PER_SCORE]


def _facts(joined: DataFrame, keep: list[str], n: Column, amount: Column, scale: int = typing.SCALE) -> DataFrame:
    """Facts of joined rows that each stand for ``n`` rows worth ``amount`` without the reviews.

    The reviews multiply both: by their number, or by 1 if there are none.
    """
    fan_out = F.coalesce(F.col("n_scored"), F.lit(1))
    return joined.select(
        *keep,
        (n * fan_out).alias("n_rows"),
        typing.times(amount, fan_out, scale).alias("amount"),
        *[(n * F.coalesce(F.col(c), F.lit(0))).alias(c) for c in SCORE_SUMS],
    )


def seller_facts(
    items: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    hot: skew.HotKeys | None = None,
    scale: int = typing.SCALE,
) -> DataFrame:
    """Facts per item with ``seller_id``; the amount is the price without freight."""
    fact = items.select(KEY, "seller_id", "price")
    copies = orders.where(F.col(KEY).isNotNull()).groupBy(KEY).agg(F.count("*").alias("n"))
    hot = hot.only(*SELLER_SIDES) if hot else skew.hot_keys(dict(zip(SELLER_SIDES, (items,))), KEY)
    per_order = copies.join(review_counts(reviews), KEY, "left")
    joined = hot.spread(fact, "items").join(hot.spread(per_order), hot.join_on)
    n = F.col("n")
    return _facts(joined, ["seller_id"], n, typing.times(typing.exact(F.col("price"), scale), n, scale), scale)


def order_facts(
    items: DataFrame,
    orders: DataFrame,
    reviews: DataFrame,
    hot: skew.HotKeys | None = None,
    scale: int = typing.SCALE,
) -> DataFrame:
    """Facts per order row with status, purchase time and delay; the amount includes freight.

    Items are summed per order before they are shuffled and joined.
    """
    sums = (
        items.where(F.col(KEY).isNotNull())
        .groupBy(KEY)
        .agg(F.count("*").alias("n"), F.sum(typing.exact(total_amount(), scale)).alias("sum_amount"))
    )
    rows = orders.select(
        KEY, "order_status", "order_purchase_timestamp", delay_days().alias("delivery_delay_days")
    )
    hot = hot.only(*ORDER_SIDES) if hot else skew.hot_keys(dict(zip(ORDER_SIDES, (orders,))), KEY)
    per_order = sums.join(review_counts(reviews), KEY, "left")
    joined = hot.spread(rows, "orders").join(hot.spread(per_order), hot.join_on)
    keep = ["order_status", "order_purchase_timestamp", "delivery_delay_days"]
    return _facts(joined, keep, F.col("n"), F.col("sum_amount"), scale)


def row_facts(enriched: DataFrame, amount: str, *keep: str, scale: int = typing.SCALE) -> DataFrame:
    """Facts read off stored enriched rows, each of which stands for itself."""
    score = F.col("review_score")
    return enriched.select(
        *keep,
        F.lit(1).cast("bigint").alias("n_rows"),
        typing.exact(F.col(amount), scale).alias("amount"),
        score.isNotNull().cast("bigint").alias("n_scored"),
        F.coalesce(score, F.lit(0)).cast("bigint").alias("score_sum"),
        *[
            F.coalesce(score == s, F.lit(False)).cast("bigint").alias(n)
            for s, n in zip(SCORES, PER_SCORE)
        ],
    )


def by_status_and_delay(facts: DataFrame) -> DataFrame:
    """Facts summed per status and delay, which is all the status and review marts need."""
    sums = ["n_rows", "amount", *SCORE_SUMS]
    return facts.groupBy("order_status", "delivery_delay_days").agg(*[F.sum(c).alias(c) for c in sums])
