"""Declared schemas of every layer, and the keys of the metric tables.

The field names and types of the topics and of the metric tables are fixed values: they are
the data contract with producers and consumers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType


def _struct(nullable: bool = True, **fields: str | DataType) -> StructType:
    schema = StructType()
    for name, kind in fields.items():
        schema = schema.add(name, kind, nullable)
    return schema


# -- topic messages ------------------------------------------------------------------------

CLICKSTREAM = _struct(
    session_id="string", user_id="string", event_type="string", page="string",
    platform="string", traffic_src="string", keyword="string", sku="string",
    dwell_ms="integer", ip="string", timestamp="string",
)

LINE_ITEM = _struct(
    sku="string", title="string", category="string", qty="integer",
    unit_price="double", subtotal="double",
)

PURCHASES = _struct(
    order_id="string", user_id="string", status="string", items=ArrayType(LINE_ITEM),
    total_amount="double", discount_pct="double", final_amount="double",
    payment_method="string", payment_status="string", ship_country="string",
    is_return="boolean", timestamp="string",
)

PRODUCT_REVIEWS = _struct(
    review_id="string", user_id="string", sku="string", rating="integer",
    review_text="string", verified_purchase="boolean", helpful_votes="integer",
    sentiment_label="string", sentiment_score="double", timestamp="string",
)

SOCIAL_BUZZ = _struct(
    post_id="string", platform="string", user_id="string", content="string",
    hashtags=ArrayType(StringType()), likes="integer", shares="integer",
    sentiment_label="string", sentiment_score="double", lang="string", timestamp="string",
)

# Shape of a message log read from Kafka, or from files that hold the same columns.
MESSAGE_LOG = _struct(
    value="binary", topic="string", partition="integer", offset="long", timestamp="timestamp",
)

_ENVELOPE = _struct(topic="string", partition="integer", offset="long", kafka_ts="timestamp")
_STAMPS = _struct(event_ts="timestamp", ingested_at="timestamp", ingestion_date="date")


def raw_schema(message: StructType) -> StructType:
    """Schema of the raw table a topic lands in: envelope, message fields, time stamps."""
    body = [f for f in message.fields if f.name != "timestamp"]
    return StructType(_ENVELOPE.fields + body + _STAMPS.fields)


# -- topic registry ------------------------------------------------------------------------

@dataclass(frozen=True)
class Topic:
    """One topic: its folder, message schema, identity, and which copy of a message wins.

    ``latest_by`` is compared in order, largest first. The trailing envelope columns make the
    choice total, so that copies landing in one batch do not tie. ``text`` is the free text of a
    message, by far its widest column.
    """

    name: str
    folder: str
    message: StructType
    required: tuple[str, ...]
    key: tuple[str, ...]
    latest_by: tuple[str, ...]
    text: str | None = None

    @property
    def raw(self) -> StructType:
        return raw_schema(self.message)


_BY_INGEST = ("ingested_at", "kafka_ts", "partition", "offset")

TOPICS: dict[str, Topic] = {
    t.folder: t
    for t in (
        Topic("clickstream", "clickstream", CLICKSTREAM, ("session_id", "event_type"),
              ("session_id", "event_type"), _BY_INGEST),
        Topic("purchases", "purchases", PURCHASES, ("order_id", "user_id"),
              ("order_id",), ("kafka_ts", "partition", "offset")),
        Topic("product-reviews", "product_reviews", PRODUCT_REVIEWS, ("review_id", "user_id"),
              ("review_id",), _BY_INGEST, "review_text"),
        Topic("social-buzz", "social_buzz", SOCIAL_BUZZ, ("post_id",),
              ("post_id",), _BY_INGEST, "content"),
    )
}


# -- metric tables -------------------------------------------------------------------------
# Counts are bigint throughout: one busy hour, category or user may hold more than 2^31 rows.

@dataclass(frozen=True)
class MetricTable:
    """A metric table: columns with types, primary key, NOT NULL columns and their defaults."""

    name: str
    columns: StructType
    key: tuple[str, ...]
    nullable: tuple[str, ...] = ()
    defaults: tuple[tuple[str, int], ...] = ()

    @property
    def not_null(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns.names if c not in self.nullable)

    @property
    def stored(self) -> StructType:
        """Columns as stored: those computed, then the load time."""
        return StructType(self.columns.fields + [StructField("created_at", _TIMESTAMP)])


_TIMESTAMP = _STAMPS["event_ts"].dataType
_WINDOW = {"window_start": "timestamp", "window_end": "timestamp"}


def _zero(*names: str) -> tuple[tuple[str, int], ...]:
    return tuple((n, 0) for n in names)


METRICS: dict[str, MetricTable] = {
    t.name: t
    for t in (
        MetricTable(
            "hourly_sales",
            _struct(**_WINDOW, category="string", gross_revenue="decimal(16,2)",
                    num_orders="long", num_returns="long"),
            ("window_start", "category"),
            defaults=_zero("gross_revenue", "num_orders", "num_returns"),
        ),
        MetricTable(
            "hourly_search_trends",
            _struct(**_WINDOW, keyword="string", search_count="long",
                    unique_visitors="long"),
            ("window_start", "keyword"),
            defaults=_zero("search_count", "unique_visitors"),
        ),
        MetricTable(
            "hourly_site_traffic",
            _struct(**_WINDOW, num_sessions="long", num_clicks="long",
                    num_pageviews="long", unique_visitors="long", avg_session_ms="long"),
            ("window_start",),
            defaults=_zero("num_sessions", "num_clicks", "num_pageviews", "unique_visitors",
                           "avg_session_ms"),
        ),
        MetricTable(
            "hourly_sentiment",
            _struct(**_WINDOW, data_source="string", mean_sentiment="decimal(7,4)",
                    positive_cnt="long", neutral_cnt="long", negative_cnt="long",
                    total_cnt="long"),
            ("window_start", "data_source"),
            defaults=_zero("mean_sentiment", "positive_cnt", "neutral_cnt", "negative_cnt",
                           "total_cnt"),
        ),
        MetricTable(
            "user_segments",
            _struct(**_WINDOW, user_id="string", segment="string",
                    revenue_30d="decimal(16,2)", order_count_30d="long",
                    last_purchase_date="date", avg_review_score="decimal(4,2)",
                    churn_score="decimal(6,4)"),
            ("window_start", "user_id"),
            nullable=("last_purchase_date", "avg_review_score"),
            defaults=_zero("revenue_30d", "order_count_30d", "churn_score"),
        ),
    )
}


# -- user profile --------------------------------------------------------------------------

PROFILE = _struct(
    user_id="string",
    updated_at="timestamp",
    purchases=_struct(
        total_orders="long", total_spent="double", total_returns="long",
        return_rate="double", last_purchase_at="string", preferred_payment="string",
        spend_distribution=_struct(low="long", mid="long", high="long"),
    ),
    reviews=_struct(
        avg_rating="double", total_reviews="long", avg_sentiment="double",
        breakdown=_struct(positive="long", neutral="long", negative="long"),
    ),
    browsing=_struct(
        total_sessions="long", total_views="long", total_searches="long",
        total_cart_adds="long", last_active_at="string", top_platform="string",
    ),
    social=_struct(
        post_count="long", avg_sentiment="double", avg_engagement="double",
        viral_posts="long", platforms=ArrayType(StringType()),
    ),
    segment=_struct(
        label="string", churn_score="double", revenue_30d="double",
        order_count_30d="long", last_purchase_date="string", avg_review_score="double",
    ),
)
