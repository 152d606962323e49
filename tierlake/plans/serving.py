"""Read queries over the metric tables and the profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierlake.functions import bands
from tierlake.functions.numeric import ratio
from tierlake.functions.text import title_text


# -- overview ------------------------------------------------------------------------------

def kpi_sales(sales: DataFrame) -> DataFrame:
    """Totals, and returned lines per 100 orders (0 when there are no orders)."""
    totals = sales.agg(F.sum("gross_revenue").alias("revenue"),
                       F.sum("num_orders").alias("orders"),
                       F.sum("num_returns").alias("returns"))
    rate = ratio(F.col("returns"), F.col("orders"), 1, scale=100.0)
    return totals.withColumn("return_rate_pct", F.coalesce(rate, F.lit(0.0)))


def kpi_traffic(traffic: DataFrame) -> DataFrame:
    """Totals over hours, and the mean of the hourly mean dwell times in seconds.

    Visitors of several hours count once in each of them.
    """
    return traffic.agg(
        F.sum("num_sessions").alias("sessions"),
        F.sum("unique_visitors").alias("visitors"),
        F.round(F.avg("avg_session_ms") / 1000, 1).alias("avg_session_s"))


def segment_counts(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(F.count("*").alias("cnt")).orderBy(
        F.desc("cnt"), "segment")


def segment_share(segments: DataFrame) -> DataFrame:
    """Users per segment and their share in percent; the window runs over one row per segment."""
    share = F.round(F.col("cnt") * 100.0 / F.sum("cnt").over(Window.partitionBy()), 1)
    counts = segments.groupBy("segment").agg(F.count("*").alias("cnt"))
    return counts.select("segment", title_text("segment").alias("title"), "cnt",
                         share.alias("share_pct")).orderBy(F.desc("cnt"), "segment")


def revenue_by_category(sales: DataFrame) -> DataFrame:
    return sales.groupBy("category").agg(
        F.sum("gross_revenue").alias("revenue"), F.sum("num_orders").alias("orders")
    ).orderBy(F.desc("revenue"), "category")


def traffic_series(traffic: DataFrame) -> DataFrame:
    return traffic.select("window_start", "num_sessions", "num_clicks", "num_pageviews",
                          "unique_visitors").orderBy("window_start")


# -- keywords and sentiment ----------------------------------------------------------------

def top_keywords(trends: DataFrame, top_n: int = 20, min_count: int = 2) -> DataFrame:
    """Keywords with most searches, over the hours that reach ``min_count``."""
    totals = trends.filter(F.col("search_count") >= min_count).groupBy("keyword").agg(
        F.sum("search_count").alias("total_searches"),
        F.sum("unique_visitors").alias("total_users"))
    return (totals.orderBy(F.desc("total_searches"), "keyword").limit(top_n)
            .withColumn("searches_per_user",
                        ratio(F.col("total_searches"), F.col("total_users"), 2)))


def profile_sentiment(profiles: DataFrame) -> DataFrame:
    """Mean review and social sentiment over the profiles that have reviews."""
    return profiles.filter(F.col("reviews.avg_sentiment").isNotNull()).agg(
        F.round(F.avg("reviews.avg_sentiment"), 3).alias("avg_review_sentiment"),
        F.round(F.avg("social.avg_sentiment"), 3).alias("avg_social_sentiment"),
        F.count("*").alias("profiles"))


def sentiment_breakdown(sentiment: DataFrame) -> DataFrame:
    """Each hour and source with label percentages; the mood here is strict (> 0.05, > -0.05)."""
    score = F.round(F.col("mean_sentiment").cast("double"), 3)
    total = F.greatest("total_cnt", F.lit(1))
    return sentiment.select(
        "window_start", "data_source", title_text("data_source").alias("title"),
        score.alias("score"),
        F.when(score > bands.POSITIVE_FROM, "positive")
        .when(score > bands.NEGATIVE_FROM, "neutral").otherwise("negative").alias("mood"),
        *(ratio(F.col(f"{label}_cnt"), total, 1, scale=100.0).alias(f"{label}_pct")
          for label in ("positive", "neutral", "negative")),
    ).orderBy("data_source", "window_start")


# -- profiles ------------------------------------------------------------------------------

def recent_profiles(profiles: DataFrame, top_n: int = 5) -> DataFrame:
    return profiles.select("user_id", F.col("segment.label").alias("segment"), "updated_at"
                           ).orderBy(F.desc("updated_at"), "user_id").limit(top_n)


def profile_lookup(profiles: DataFrame, user_id: str) -> DataFrame:
    """The profile of one user (the id is trimmed first) with its churn level.

    The comparison is with a literal, so a Parquet scan skips row groups by their statistics.
    """
    return profiles.filter(F.col("user_id") == user_id.strip()).withColumn(
        "churn_level", bands.churn_level(F.col("segment.churn_score")))


def live_risk_count(profiles: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Number of profiles, and of those at or over a churn score."""
    return profiles.agg(
        F.count("*").alias("profiles"),
        F.count_if(F.col("segment.churn_score") >= threshold).alias("at_risk"))


# -- churn ---------------------------------------------------------------------------------

DEFAULT_RISK_SEGMENTS = ("at_risk", "regular")


def churn_risk_users(segments: DataFrame, threshold: float = 0.5,
                     only: Sequence[str] = DEFAULT_RISK_SEGMENTS,
                     top_n: int | None = 50) -> DataFrame:
    """Users with the highest churn scores, or all at risk where ``top_n`` is None; an empty
    ``only`` does not restrict segments."""
    rows = segments.filter(F.col("churn_score") >= F.lit(threshold))
    if only:
        rows = rows.filter(F.col("segment").isin(*only))
    rows = rows.select("user_id", "segment", "churn_score", "revenue_30d", "order_count_30d",
                       "last_purchase_date", "avg_review_score")
    return rows if top_n is None else rows.orderBy(F.desc("churn_score"), "user_id").limit(top_n)


def churn_risk_summary(risk: DataFrame) -> DataFrame:
    return risk.agg(F.count("*").alias("matching"),
                    F.round(F.avg(F.col("churn_score").cast("double")), 4).alias("avg_churn"),
                    F.round(F.avg(F.col("revenue_30d").cast("double")), 2).alias("avg_revenue"))


def churn_histogram(risk: DataFrame, bins: int = 10) -> DataFrame:
    """Equal-width histogram of churn scores, empty bins kept.

    Bins are closed on the right and the minimum belongs to bin 1; if all scores are equal, bin 1
    holds them all. Scores have four places, so bin numbers are worked out in whole numbers.
    """
    everything = Window.partitionBy()
    # One row per distinct score, 10,001 at most: the windows below run over no more than that.
    scores = risk.groupBy((F.col("churn_score").cast("decimal(10,4)") * 10000).cast("long")
                          .alias("u")).agg(F.count("*").alias("n"))
    spanned = scores.withColumns({"lo": F.min("u").over(everything),
                                  "hi": F.max("u").over(everything)})
    steps = F.ceil((F.col("u") - F.col("lo")) * bins
                   / F.greatest(F.col("hi") - F.col("lo"), F.lit(1)))
    counted = spanned.groupBy(F.greatest(steps, F.lit(1)).cast("int").alias("bin")).agg(
        F.sum("n").alias("n"), F.first("lo").alias("lo"), F.first("hi").alias("hi"))
    numbers = risk.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    filled = numbers.join(counted, "bin", "left").withColumns({
        "lo": F.max("lo").over(everything), "hi": F.max("hi").over(everything)})

    def edge(steps_from_low: Column) -> Column:
        return F.round((F.col("lo") + (F.col("hi") - F.col("lo")) * steps_from_low / bins)
                       / 10000, 6)

    return filled.select(
        "bin", edge(F.col("bin") - 1).alias("lower"), edge(F.col("bin")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n")).orderBy("bin")


def churn_scatter(risk: DataFrame) -> DataFrame:
    return risk.select("user_id", "revenue_30d", "churn_score", "segment")
