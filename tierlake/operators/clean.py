"""Raw rows to clean rows, per topic: drop incomplete rows, dedup, enrich.

``dedup_topic`` and the ``enrich_*`` functions are separate because a stream keeps deduplicated
but not yet enriched rows (see streaming.clean_log).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierlake.functions import bands
from tierlake.operators.dedup import dedup_topic


def _ingestion_date():
    return F.to_date("ingested_at")


def enrich_clickstream(df: DataFrame) -> DataFrame:
    """Time parts and flags. ``is_checkout`` marks add_to_cart events, as the contract names it;
    ``is_bot`` of a null dwell time is null."""
    return df.withColumns({
        "hour_of_day": F.hour("event_ts"),
        "day_of_week": F.dayofweek("event_ts"),
        "is_weekend": F.dayofweek("event_ts").isin(1, 7),
        "is_bot": F.col("dwell_ms") < bands.BOT_DWELL_MS,
        "is_search": F.col("event_type") == "search",
        "is_checkout": F.col("event_type") == "add_to_cart",
        "ingestion_date": _ingestion_date(),
    })


def explode_items(orders: DataFrame) -> DataFrame:
    """One row per line item; an order with no items, or null items, disappears."""
    item = F.col("item")
    return orders.withColumn("item", F.explode("items")).withColumns({
        "item_sku": item["sku"],
        "item_title": item["title"],
        "item_category": item["category"],
        "item_qty": item["qty"],
        "item_unit_price": item["unit_price"],
        "item_subtotal": item["subtotal"],
    }).drop("item", "items")


def enrich_purchases(df: DataFrame) -> DataFrame:
    """One row per line item; the order-level columns repeat on each, and so does the band of
    the order's final amount."""
    return explode_items(df).withColumns({
        "spend_band": bands.spend_band(),
        "hour_of_day": F.hour("event_ts"),
        "ingestion_date": _ingestion_date(),
    })


def enrich_product_reviews(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "sentiment_band": bands.sentiment_band(),
        "rating_group": bands.rating_group(),
        "ingestion_date": _ingestion_date(),
    })


def enrich_social_buzz(df: DataFrame) -> DataFrame:
    score = bands.engagement_score()
    return df.withColumns({
        "engagement_score": score,
        "is_viral": score > bands.VIRAL_SCORE,
        "has_user": F.col("user_id").isNotNull(),
        "ingestion_date": _ingestion_date(),
    })


ENRICH = {
    "clickstream": enrich_clickstream,
    "purchases": enrich_purchases,
    "product_reviews": enrich_product_reviews,
    "social_buzz": enrich_social_buzz,
}


def clean_topic(raw: DataFrame, folder: str) -> DataFrame:
    """Raw table to clean table of one topic."""
    return ENRICH[folder](dedup_topic(raw, folder))
