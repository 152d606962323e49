"""The four hourly metric tables, computed from clean tables.

Spark plans each exact distinct count as an aggregate on (group, value) before the one on the
group, and adds partial sums in every task, so one busy hour or category is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.functions import bands
from tierlake.functions.numeric import money_sum, score_mean
from tierlake.schemas import METRICS

HOUR = "1 hour"


def hour_window(event_ts: str = "event_ts") -> Column:
    """The hour an event falls in, as struct ``w`` of start and end; rows without a time drop."""
    return F.window(event_ts, HOUR).alias("w")


def _columns(df: DataFrame, table: str) -> DataFrame:
    return df.withColumns({"window_start": F.col("w.start"), "window_end": F.col("w.end")}
                          ).select(*METRICS[table].columns.names)


def hourly_sales(purchases: DataFrame) -> DataFrame:
    """Paid revenue, orders and returned lines by hour and item category.

    ``num_returns`` counts line items, not orders.
    """
    grouped = purchases.filter(F.col("payment_status") == "success").groupBy(
        hour_window(), F.col("item_category").alias("category"))
    return _columns(grouped.agg(
        money_sum("item_subtotal").alias("gross_revenue"),
        F.count_distinct("order_id").alias("num_orders"),
        F.count_if("is_return").alias("num_returns"),
    ), "hourly_sales")


def hourly_search_trends(clicks: DataFrame) -> DataFrame:
    """Searches and searching users by hour and lower-cased keyword, for keywords searched more
    than once in the hour."""
    grouped = clicks.filter(F.col("is_search") & F.col("keyword").isNotNull()).groupBy(
        hour_window(), F.lower("keyword").alias("keyword"))
    return _columns(grouped.agg(
        F.count("*").alias("search_count"),
        F.count_distinct("user_id").alias("unique_visitors"),
    ).filter(F.col("search_count") > 1), "hourly_search_trends")


def hourly_site_traffic(clicks: DataFrame) -> DataFrame:
    """Traffic by hour without bots; rows of unknown bot status are left out too.

    Names follow the contract: ``num_clicks`` counts view events, ``num_pageviews`` scroll
    events, and ``avg_session_ms`` is the mean dwell time per event.
    """
    grouped = clicks.filter(~F.col("is_bot")).groupBy(hour_window())
    return _columns(grouped.agg(
        F.count_distinct("session_id").alias("num_sessions"),
        F.count_if(F.col("event_type") == "view").alias("num_clicks"),
        F.count_if(F.col("event_type") == "scroll").alias("num_pageviews"),
        F.count_distinct("user_id").alias("unique_visitors"),
        F.round(F.avg("dwell_ms"), 0).cast("long").alias("avg_session_ms"),
    ), "hourly_site_traffic")


def scored_events(df: DataFrame, source: str) -> DataFrame:
    """Times and scores of one source, tagged with its name."""
    return df.select("event_ts", "sentiment_score", F.lit(source).alias("data_source"))


def sentiment_events(reviews: DataFrame, social: DataFrame) -> DataFrame:
    """Both sources of scores as one frame, so that one aggregate serves both."""
    return scored_events(reviews, "reviews").unionByName(scored_events(social, "social_buzz"))


def aggregate_sentiment(events: DataFrame) -> DataFrame:
    """Hourly sentiment of tagged events; also accepts a stream."""
    score = F.col("sentiment_score")
    return _columns(events.groupBy(hour_window(), "data_source").agg(
        score_mean("sentiment_score", 4).cast("decimal(7,4)").alias("mean_sentiment"),
        F.count_if(score >= bands.POSITIVE_FROM).alias("positive_cnt"),
        F.count_if((score > bands.NEGATIVE_FROM) & (score < bands.POSITIVE_FROM))
        .alias("neutral_cnt"),
        F.count_if(score <= bands.NEGATIVE_FROM).alias("negative_cnt"),
        F.count("*").alias("total_cnt"),
    ), "hourly_sentiment")


def hourly_sentiment(reviews: DataFrame, social: DataFrame) -> DataFrame:
    """Mean score and label counts by hour and source; a null score counts in the total only."""
    return aggregate_sentiment(sentiment_events(reviews, social))
