"""Per-user spend and rating, churn score, and the user segment snapshot."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.functions.numeric import money_sum
from tierlake.operators.ranking import cents, percent_rank_desc, top_share_cutoff
from tierlake.schemas import METRICS
from tierlake.session import materialise

# Fixed values of the churn rule.
ORDER_WEIGHT, SPEND_WEIGHT, RATING_WEIGHT = 0.4, 0.3, 0.3
NEUTRAL_RATING, MAX_RATING = 3.0, 5.0
AT_RISK_OVER = 0.65
PLATINUM_SHARE = 0.20

LINE, ORDER = "line", "order"


def order_grain(purchases: DataFrame) -> DataFrame:
    """Clean purchases with one row per order, without the columns of its items.

    All lines of an order carry the same order-level values, so these are simply made distinct.
    """
    return purchases.select(*(c for c in purchases.columns if not c.startswith("item_"))
                            ).distinct()


def at_grain(purchases: DataFrame, grain: str) -> DataFrame:
    """Choose what a per-user sum adds up.

    ``line`` repeats the order's amount for each of its items: this overstates revenue, and is
    the contract's default. ``order`` counts each order once.
    """
    if grain not in (LINE, ORDER):
        raise ValueError(f"grain must be {LINE!r} or {ORDER!r}")
    return order_grain(purchases) if grain == ORDER else purchases


def user_spend(purchases: DataFrame, grain: str = LINE, horizon_days: int | None = None,
               as_of: datetime | None = None) -> DataFrame:
    """Paid revenue, orders, last purchase date and returns per user.

    The columns are called ``*_30d`` by contract but cover all history, unless ``horizon_days``
    restricts them to the days before ``as_of`` (exclusive start, inclusive end).
    """
    paid = purchases.select(
        "order_id", "user_id", "final_amount", "event_ts", "is_return", "payment_status"
    ).filter(F.col("payment_status") == "success")
    if horizon_days is not None:
        end = F.current_timestamp() if as_of is None else F.lit(as_of)
        start = end - F.make_dt_interval(days=F.lit(horizon_days))
        paid = paid.filter((F.col("event_ts") > start) & (F.col("event_ts") <= end))
    return at_grain(paid, grain).groupBy("user_id").agg(
        money_sum("final_amount").alias("revenue_30d"),
        F.count_distinct("order_id").alias("order_count_30d"),
        F.to_date(F.max("event_ts")).alias("last_purchase_date"),
        F.count_if("is_return").alias("ret_count"),
    )


def user_ratings(reviews: DataFrame) -> DataFrame:
    """Mean rating per user, two places."""
    return reviews.groupBy("user_id").agg(F.round(F.avg("rating"), 2).alias("avg_review_score"))


def user_stats(purchases: DataFrame, reviews: DataFrame, grain: str = LINE,
               horizon_days: int | None = None, as_of: datetime | None = None) -> DataFrame:
    """Spend of every paying user, with the rating they give if they review at all."""
    return user_spend(purchases, grain, horizon_days, as_of).join(
        user_ratings(reviews), "user_id", "left")


def _share(amount: str, largest: str) -> Column:
    """Amount over the largest one; a null or zero maximum counts as 1."""
    top = F.coalesce(F.nullif(F.col(largest).cast("double"), F.lit(0.0)), F.lit(1.0))
    return F.col(amount).cast("double") / top


def churn_score(max_revenue: str = "max_revenue", max_orders: str = "max_orders") -> Column:
    rating = F.coalesce(F.col("avg_review_score"), F.lit(NEUTRAL_RATING)) / MAX_RATING
    return F.round(
        ORDER_WEIGHT * (1 - _share("order_count_30d", max_orders))
        + SPEND_WEIGHT * (1 - _share("revenue_30d", max_revenue))
        + RATING_WEIGHT * (1 - rating), 4)


def _maxima(stats: DataFrame) -> DataFrame:
    return stats.agg(F.max("revenue_30d").alias("max_revenue"),
                     F.max("order_count_30d").alias("max_orders"))


def score_churn(stats: DataFrame) -> DataFrame:
    """Add ``churn_score`` to user stats, relative to the largest revenue and order count.

    The maxima are one row, broadcast to all tasks; nothing goes through the driver program.
    """
    return (stats.crossJoin(F.broadcast(_maxima(stats)))
            .withColumn("churn_score", churn_score()).drop("max_revenue", "max_orders"))


def spend_percent_rank(stats: DataFrame) -> DataFrame:
    """Add ``spend_rank``, the percent_rank of revenue, largest first."""
    ranked = percent_rank_desc(stats.withColumn("_cents", cents("revenue_30d")),
                               "_cents", "spend_rank")
    return ranked.drop("_cents")


def segment_label(is_top: Column) -> Column:
    """First match of: one order, high churn score, top spender."""
    return (F.when(F.col("order_count_30d") == 1, "new")
            .when(F.col("churn_score") > AT_RISK_OVER, "at_risk")
            .when(is_top, "platinum")
            .otherwise("regular"))


def user_segments(purchases: DataFrame, reviews: DataFrame, as_of: datetime | None = None,
                  grain: str = LINE, horizon_days: int | None = None) -> DataFrame:
    """Segment snapshot: one row per user with a paid order, stamped ``as_of`` (default now).

    Whether a user is among the top fifth of spenders only needs one number for the whole
    table, the revenue at the 20 % mark, so users are never ranked or sorted themselves. The
    per-user stats are stored first, because they are read three times.
    """
    stats = materialise(user_stats(purchases, reviews, grain, horizon_days, as_of), "user-stats")
    cutoff = top_share_cutoff(stats.select(cents("revenue_30d").alias("_cents")), "_cents",
                              PLATINUM_SHARE)
    limits = F.broadcast(_maxima(stats).crossJoin(cutoff))
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    scored = (
        stats.crossJoin(limits)
        .withColumn("churn_score", churn_score())
        .withColumn("segment", segment_label(F.coalesce(
            cents("revenue_30d") >= F.col("cutoff"),
            F.col("revenue_30d").isNull() & F.col("null_is_top"))))
        .withColumns({"window_start": now, "window_end": now})
    )
    table = METRICS["user_segments"].columns
    return scored.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in table.fields))
