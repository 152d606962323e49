"""Per-user profile sections and the nested profile, one row per user."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.functions.numeric import money_sum, ratio, score_mean
from tierlake.functions.text import iso_text
from tierlake.operators.dedup import latest_by_key
from tierlake.operators.segments import LINE, at_grain
from tierlake.schemas import PROFILE

#: Columns of the clean tables that profiles and segments read.
READS = {
    "purchases": ("user_id", "order_id", "payment_method", "payment_status", "final_amount",
                  "is_return", "event_ts", "spend_band"),
    "product_reviews": ("user_id", "rating", "sentiment_score", "sentiment_label"),
    "clickstream": ("user_id", "session_id", "event_type", "platform", "event_ts", "is_bot",
                    "is_search", "is_checkout"),
    "social_buzz": ("user_id", "platform", "sentiment_score", "engagement_score", "is_viral"),
}
SECTIONS = ("purchases", "reviews", "browsing", "social", "segment")


def _known_users(df: DataFrame) -> DataFrame:
    return df.filter(F.col("user_id").isNotNull())


def preferred_value(df: DataFrame, value: str, output: str) -> DataFrame:
    """Most frequent non-null value per user; the smallest one when several are as frequent.

    Counts per (user, value) are added up before any user's values meet, so a very active user
    costs no task more than one row per distinct value.
    """
    counts = df.filter(F.col(value).isNotNull()).groupBy("user_id", value).agg(
        F.count("*").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("rank"), F.col(value).alias("value")))
    return counts.groupBy("user_id").agg(best["value"].alias(output))


def preferred_payment(purchases: DataFrame) -> DataFrame:
    return preferred_value(_known_users(purchases), "payment_method", "preferred_payment")


def _human_clicks(clicks: DataFrame) -> DataFrame:
    return _known_users(clicks).filter(~F.col("is_bot"))


def top_platform(clicks: DataFrame) -> DataFrame:
    return preferred_value(_human_clicks(clicks), "platform", "top_platform")


def profile_purchases(purchases: DataFrame, grain: str = LINE) -> DataFrame:
    """Orders, spend, returns, last purchase, preferred payment and spend bands per user.

    At line grain, the default, amounts, returns and bands count once per line item, so
    ``return_rate`` can exceed 1; at order grain once per order.
    """
    # Narrow before the rows of an order are made one.
    rows = at_grain(_known_users(purchases).select(
        "user_id", "order_id", "payment_method", "final_amount", "is_return", "event_ts",
        "spend_band"), grain)
    totals = rows.groupBy("user_id").agg(
        F.mode("payment_method", True).alias("preferred_payment"),
        F.count_distinct("order_id").alias("total_orders"),
        money_sum("final_amount").cast("double").alias("total_spent"),
        F.count_if("is_return").alias("total_returns"),
        F.max("event_ts").alias("_last"),
        F.count_if(F.col("spend_band") == "low").alias("band_low"),
        F.count_if(F.col("spend_band") == "mid").alias("band_mid"),
        F.count_if(F.col("spend_band") == "high").alias("band_high"),
    )
    return totals.select(
        "user_id", "total_orders",
        F.coalesce("total_spent", F.lit(0.0)).alias("total_spent"),
        "total_returns",
        ratio(F.col("total_returns"), F.greatest("total_orders", F.lit(1)), 4)
        .alias("return_rate"),
        iso_text("_last").alias("last_purchase_at"),
        "preferred_payment", "band_low", "band_mid", "band_high",
    )


def profile_reviews(reviews: DataFrame) -> DataFrame:
    """Mean rating, reviews, mean sentiment and label counts per user."""
    zero = F.lit(0.0)
    label = F.col("sentiment_label")
    return _known_users(reviews).groupBy("user_id").agg(
        F.coalesce(F.round(F.avg("rating"), 2), zero).alias("avg_rating"),
        F.count("*").alias("total_reviews"),
        F.coalesce(score_mean("sentiment_score", 4), zero).alias("avg_sentiment"),
        F.count_if(label == "positive").alias("positive"),
        F.count_if(label == "neutral").alias("neutral"),
        F.count_if(label == "negative").alias("negative"),
    )


def profile_browsing(clicks: DataFrame) -> DataFrame:
    """Sessions, views, searches, cart adds, last activity and platform per user, without bots."""
    rows = _human_clicks(clicks)
    totals = rows.groupBy("user_id").agg(
        F.mode("platform", True).alias("top_platform"),
        F.count_distinct("session_id").alias("total_sessions"),
        F.count_if(F.col("event_type") == "view").alias("total_views"),
        F.count_if("is_search").alias("total_searches"),
        F.count_if("is_checkout").alias("total_cart_adds"),
        F.max("event_ts").alias("_last"),
    )
    return totals.select(
        "user_id", "total_sessions", "total_views", "total_searches", "total_cart_adds",
        iso_text("_last").alias("last_active_at"), "top_platform",
    )


def profile_social(social: DataFrame) -> DataFrame:
    """Posts, mean sentiment and engagement, viral posts and the sorted platforms per user.

    Aggregated per (user, platform) first: an active user arrives at the second step as one row
    per platform.
    """
    score = F.col("sentiment_score").try_cast("decimal(18,8)")
    per_platform = _known_users(social).groupBy("user_id", "platform").agg(
        F.count("*").alias("n"),
        F.count_if("is_viral").alias("viral"),
        F.sum(score).alias("score_sum"), F.count(score).alias("score_n"),
        F.sum("engagement_score").alias("engagement_sum"),
        F.count("engagement_score").alias("engagement_n"),
    )
    zero = F.lit(0.0)
    return per_platform.groupBy("user_id").agg(
        F.sum("n").alias("post_count"),
        F.coalesce(ratio(F.sum("score_sum"), F.sum("score_n"), 4), zero).alias("avg_sentiment"),
        F.coalesce(ratio(F.sum("engagement_sum"), F.sum("engagement_n"), 2), zero)
        .alias("avg_engagement"),
        F.sum("viral").alias("viral_posts"),
        F.sort_array(F.collect_list("platform")).alias("platforms"),
    )


def profile_keys(*frames: DataFrame) -> DataFrame:
    """Every user id that occurs in any of the frames, once."""
    keys = (_known_users(df).select("user_id") for df in frames)
    return reduce(DataFrame.unionByName, keys).distinct()


def _segment_section(segments: DataFrame) -> DataFrame:
    """The latest snapshot row of each user, with text and double types as profiles have them."""
    latest = latest_by_key(_known_users(segments), ["user_id"], ["window_start"])
    return latest.select(
        "user_id", F.col("segment").alias("label"),
        F.col("churn_score").cast("double").alias("churn_score"),
        F.col("revenue_30d").cast("double").alias("revenue_30d"),
        "order_count_30d",
        F.col("last_purchase_date").cast("string").alias("last_purchase_date"),
        F.col("avg_review_score").cast("double").alias("avg_review_score"),
    )


def _section_struct(name: str) -> Column:
    """A profile section from the columns of its flat frame."""
    nested = {"purchases": ("spend_distribution", {"low": "band_low", "mid": "band_mid",
                                                   "high": "band_high"}),
              "reviews": ("breakdown", {n: n for n in ("positive", "neutral", "negative")})}
    inner_name, inner = nested.get(name, (None, {}))
    fields = []
    for field in PROFILE[name].dataType.fields:
        if field.name == inner_name:
            value = F.struct(*(F.col(source).alias(n) for n, source in inner.items()))
        else:
            value = F.col(field.name)
        fields.append(value.alias(field.name))
    return F.struct(*fields)


def _with_unknown_segment(segment: Column) -> Column:
    """The segment section, or label ``unknown`` with zeros where a user has none."""
    def default(field: str, value: str | float | int) -> Column:
        return F.coalesce(segment[field], F.lit(value)).alias(field)

    return F.struct(
        default("label", "unknown"), default("churn_score", 0.0), default("revenue_30d", 0.0),
        F.coalesce(segment["order_count_30d"], F.lit(0).cast("long")).alias("order_count_30d"),
        segment["last_purchase_date"].alias("last_purchase_date"),
        default("avg_review_score", 0.0),
    )


def user_profiles(purchases: DataFrame, reviews: DataFrame, clicks: DataFrame,
                  social: DataFrame, segments: DataFrame, as_of: datetime | None = None,
                  grain: str = LINE) -> DataFrame:
    """One nested profile for every user seen in any source.

    A full outer join of five per-user frames, written as a union of partly filled rows that one
    aggregate on the user id folds together: chained outer joins would shuffle the growing row
    again for each source. A section without data is a null struct; ``segment`` is always there.
    """
    flat = {
        "purchases": profile_purchases(purchases, grain),
        "reviews": profile_reviews(reviews),
        "browsing": profile_browsing(clicks),
        "social": profile_social(social),
        "segment": _segment_section(segments),
    }
    parts = (df.select("user_id", _section_struct(name).alias(name)) for name, df in flat.items())
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    merged = rows.groupBy("user_id").agg(
        *(F.first(name, ignorenulls=True).alias(name) for name in SECTIONS))
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    return merged.select(
        "user_id", now.alias("updated_at"), *SECTIONS[:-1],
        _with_unknown_segment(F.col("segment")).alias("segment"))


def first_users(profiles: DataFrame, limit: int) -> DataFrame:
    """Profiles of the first users in id order."""
    return profiles.orderBy("user_id").limit(limit)


def flatten_profiles(profiles: DataFrame) -> DataFrame:
    """Profile fields as top-level columns ``section_field``; ``platforms`` as text."""
    columns: list[Column] = [F.col("user_id"), F.col("updated_at")]
    for section in SECTIONS:
        for field in PROFILE[section].dataType.fields:
            path, name = f"{section}.{field.name}", f"{section}_{field.name}"
            if field.name == "platforms":
                columns.append(F.array_join(path, ",").alias(name))
            elif hasattr(field.dataType, "fields"):
                columns += [F.col(f"{path}.{inner.name}").alias(f"{section}_{inner.name}")
                            for inner in field.dataType.fields]
            else:
                columns.append(F.col(path).alias(name))
    return profiles.select(*columns)
