"""The SQL twin of every query, for DuckDB over the given tables.

``VIEWS`` are named sub-queries over the tables and over each other; ``sql`` puts in front of a
statement the ones it needs.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2002-01-01 00:00:00'"
HORIZON_AS_OF = "TIMESTAMP '2001-06-30 00:00:00'"


def r(expression: str, digits: int) -> str:
    """Round a double half up on its decimal text, as Spark's round does."""
    return (f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38,18)), {digits})"
            " AS DOUBLE)")


def mean(column: str, digits: int) -> str:
    total = f"CAST(sum(CAST({column} AS DECIMAL(18,8))) AS DOUBLE)"
    return r(f"({total} / nullif(count({column}), 0))", digits)


def iso(column: str) -> str:
    return (f"strftime({column}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({column}) % 1000000"
            f" = 0 THEN '' ELSE strftime({column}, '.%f') END")


VIEWS: dict[str, str] = {}

# -- topics ----------------------------------------------------------------------------------

VIEWS["raw_clickstream"] = """
SELECT 'clickstream' AS topic, CAST(event_id % 3 AS INT) AS "partition", event_id AS "offset",
  ts AS kafka_ts,
  CASE WHEN event_id % 97 <> 0
       THEN 'S-' || user_id || '-' || strftime(ts, '%Y%m%d') END AS session_id,
  'USR-' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS user_id,
  CASE event_type WHEN 'click' THEN 'scroll' WHEN 'signup' THEN 'search'
       WHEN 'purchase' THEN 'add_to_cart' WHEN 'error' THEN 'remove_from_cart'
       ELSE 'view' END AS event_type,
  '/p' || (event_id % 8) AS page,
  CASE event_id % 3 WHEN 0 THEN 'mobile_app' WHEN 1 THEN 'desktop_web'
       ELSE 'tablet_web' END AS platform,
  CASE event_id % 3 WHEN 0 THEN 'organic' WHEN 1 THEN 'email' ELSE 'direct' END AS traffic_src,
  CASE WHEN event_type = 'signup' AND event_id % 13 <> 0
       THEN (CASE WHEN event_id % 2 = 0 THEN 'KW' ELSE 'kw' END)
            || (CAST(json_extract(props, '$.k') AS INT) % 3) END AS keyword,
  CASE WHEN event_id % 5 < 2
       THEN 'SKU-' || lpad(CAST(event_id % 250 AS VARCHAR), 5, '0') END AS sku,
  CASE WHEN event_id % 53 <> 0 THEN CAST(floor(value * 10) AS INT) END AS dwell_ms,
  '10.' || (user_id % 256) || '.' || (event_id % 256) || '.7' AS ip,
  ts AS event_ts, ts AS ingested_at, CAST(ts AS DATE) AS ingestion_date
FROM events"""

VIEWS["order_copies"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_orderkey % 5 AS m5,
  CAST(round(o_totalprice * 100) AS BIGINT) AS total_cents,
  (CAST(round(o_totalprice * 100) AS BIGINT) * (100 - (o_orderkey % 5) * 5) + 50) // 100
    AS final_cents,
  o_orderdate + to_hours(CAST(o_orderkey % 24 AS INT)) AS event_ts, copy
FROM orders JOIN (SELECT 1 AS copy UNION ALL SELECT 2) c ON copy = 1 OR o_orderkey % 10 = 0"""

VIEWS["raw_purchases"] = """
SELECT 'purchases' AS topic, CAST(o_orderkey % 3 AS INT) AS "partition",
  o_orderkey * 2 + copy AS "offset", event_ts + to_minutes(copy - 1) AS kafka_ts,
  'ORD-' || o_orderkey AS order_id, o_orderkey,
  CASE WHEN o_orderkey % 89 <> 0
       THEN 'USR-' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') END AS user_id,
  CASE WHEN copy = 1 AND o_orderkey % 10 = 0 THEN 'placed' WHEN o_orderstatus = 'P'
       THEN 'returned' WHEN o_orderstatus = 'F' THEN 'delivered' ELSE 'placed' END AS status,
  CAST(total_cents AS DOUBLE) / 100 AS total_amount, CAST(m5 * 5 AS DOUBLE) AS discount_pct,
  CAST(final_cents AS DOUBLE) / 100 AS final_amount,
  CASE o_orderkey % 4 WHEN 0 THEN 'card' WHEN 1 THEN 'upi' WHEN 2 THEN 'wallet'
       ELSE 'cod' END AS payment_method,
  CASE WHEN m5 < 3 THEN 'success' WHEN m5 = 3 THEN 'failed' ELSE 'pending' END
    AS payment_status,
  'IN' AS ship_country,
  o_orderstatus = 'P' AND NOT (copy = 1 AND o_orderkey % 10 = 0) AS is_return,
  event_ts, event_ts + to_minutes(copy - 1) AS ingested_at,
  CAST(event_ts + to_minutes(copy - 1) AS DATE) AS ingestion_date
FROM order_copies"""

VIEWS["order_items"] = """
SELECT l_orderkey AS o_orderkey, 'SKU-' || lpad(CAST(p_partkey AS VARCHAR), 5, '0') AS item_sku,
  p_name AS item_title, p_type AS item_category, CAST(l_quantity AS INT) AS item_qty,
  p_retailprice AS item_unit_price, l_extendedprice AS item_subtotal
FROM lineitem JOIN part ON p_partkey = l_partkey"""

VIEWS["items_text"] = """
SELECT o_orderkey, count(*) AS n_items,
  string_agg(item_sku || '|' || item_title || '|' || item_category || '|' || item_qty || '|'
             || CAST(CAST(item_unit_price AS DECIMAL(16,2)) AS VARCHAR) || '|'
             || CAST(CAST(item_subtotal AS DECIMAL(16,2)) AS VARCHAR), ';'
             ORDER BY item_sku, item_subtotal, item_qty) AS items
FROM order_items GROUP BY 1"""

VIEWS["raw_product_reviews"] = """
SELECT 'product-reviews' AS topic, CAST(o_orderkey % 2 AS INT) AS "partition",
  o_orderkey * 2 + copy AS "offset", event_ts + to_minutes(copy - 1) AS kafka_ts,
  'RVW-' || o_orderkey AS review_id, o_orderkey,
  CASE WHEN o_orderkey % 83 <> 0
        AND o_custkey % 7 <> 0
       THEN 'USR-' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') END AS user_id,
  'SKU-' || lpad(CAST(o_orderkey % 250 AS VARCHAR), 5, '0') AS sku,
  CASE WHEN copy = 1 AND o_orderkey % 9 = 0 THEN 3
       ELSE 6 - CAST(substr(o_orderpriority, 1, 1) AS INT) END AS rating,
  o_orderkey % 5 <> 0 AS verified_purchase, CAST(o_orderkey % 81 AS INT) AS helpful_votes,
  CASE WHEN (o_orderkey * 37) % 201 - 100 >= 5 THEN 'positive'
       WHEN (o_orderkey * 37) % 201 - 100 <= -5 THEN 'negative' ELSE 'neutral' END
    AS sentiment_label,
  CAST((o_orderkey * 37) % 201 - 100 AS DOUBLE) / 100 AS sentiment_score, text AS review_text,
  event_ts, event_ts + to_minutes(copy - 1) AS ingested_at,
  CAST(event_ts + to_minutes(copy - 1) AS DATE) AS ingestion_date
FROM (SELECT o.*, o.o_orderdate + to_hours(CAST(o.o_orderkey % 24 AS INT)) AS event_ts, c.copy
      FROM orders o JOIN (SELECT 1 AS copy UNION ALL SELECT 2) c
        ON c.copy = 1 OR o.o_orderkey % 9 = 0) o
  LEFT JOIN documents ON doc_id = o_orderkey % (SELECT count(*) FROM documents)"""

VIEWS["raw_social_buzz"] = """
SELECT 'social-buzz' AS topic, CAST(event_id % 2 AS INT) AS "partition",
  event_id * 2 + copy AS "offset", ts + to_minutes(copy - 1) AS kafka_ts, event_id,
  CASE WHEN event_id % 101 <> 0 THEN 'PST-' || event_id END AS post_id,
  CASE event_id % 4 WHEN 0 THEN 'instagram' WHEN 1 THEN 'twitter' WHEN 2 THEN 'facebook'
       ELSE 'youtube' END AS platform,
  CASE WHEN event_id % 7 <> 0 AND user_id % 11 <> 0
       THEN 'USR-' || lpad(CAST(user_id AS VARCHAR), 6, '0') END AS user_id,
  CASE event_id % 3 WHEN 0 THEN '#a,#b' WHEN 1 THEN '#b' ELSE '#a' END AS hashtags,
  CASE WHEN copy = 1 AND event_id % 11 = 0 THEN 0 ELSE CAST(floor(value) AS INT) END AS likes,
  CAST(json_extract(props, '$.k') AS INT) AS shares,
  CASE WHEN (event_id * 53) % 201 - 100 >= 5 THEN 'positive'
       WHEN (event_id * 53) % 201 - 100 <= -5 THEN 'negative' ELSE 'neutral' END
    AS sentiment_label,
  CAST((event_id * 53) % 201 - 100 AS DOUBLE) / 100 AS sentiment_score, text AS content,
  'en' AS lang, ts AS event_ts, ts + to_minutes(copy - 1) AS ingested_at,
  CAST(ts + to_minutes(copy - 1) AS DATE) AS ingestion_date
FROM events JOIN (SELECT 1 AS copy UNION ALL SELECT 2) c ON copy = 1 OR event_id % 11 = 0
LEFT JOIN documents ON doc_id = event_id % (SELECT count(*) FROM documents)"""

# -- dedup and clean -------------------------------------------------------------------------

_LATEST = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn
  FROM {source} WHERE {required})
WHERE rn = 1"""
_BY_INGEST = 'ingested_at DESC, kafka_ts DESC, "partition" DESC, "offset" DESC'

VIEWS["one_clickstream"] = _LATEST.format(
    key="session_id, event_type", order=_BY_INGEST, source="raw_clickstream",
    required="session_id IS NOT NULL AND event_type IS NOT NULL")
VIEWS["one_purchases"] = _LATEST.format(
    key="order_id", order='kafka_ts DESC, "partition" DESC, "offset" DESC',
    source="raw_purchases", required="order_id IS NOT NULL AND user_id IS NOT NULL")
VIEWS["one_product_reviews"] = _LATEST.format(
    key="review_id", order=_BY_INGEST, source="raw_product_reviews",
    required="review_id IS NOT NULL AND user_id IS NOT NULL")
VIEWS["one_social_buzz"] = _LATEST.format(
    key="post_id", order=_BY_INGEST, source="raw_social_buzz", required="post_id IS NOT NULL")

VIEWS["clickstream"] = """
SELECT *, CAST(hour(event_ts) AS INT) AS hour_of_day,
  CAST(dayofweek(event_ts) + 1 AS INT) AS day_of_week,
  dayofweek(event_ts) IN (0, 6) AS is_weekend,
  dwell_ms < 120 AS is_bot, event_type = 'search' AS is_search,
  event_type = 'add_to_cart' AS is_checkout
FROM one_clickstream"""

VIEWS["purchases"] = """
SELECT p.*, i.* EXCLUDE (o_orderkey),
  CASE WHEN final_amount < 500 THEN 'low' WHEN final_amount < 2500 THEN 'mid'
       ELSE 'high' END AS spend_band,
  CAST(hour(event_ts) AS INT) AS hour_of_day
FROM one_purchases p JOIN order_items i USING (o_orderkey)"""

VIEWS["product_reviews"] = """
SELECT *,
  CASE WHEN sentiment_score >= 0.5 THEN 'very_positive' WHEN sentiment_score >= 0.05
       THEN 'positive' WHEN sentiment_score > -0.05 THEN 'neutral' WHEN sentiment_score > -0.5
       THEN 'negative' ELSE 'very_negative' END AS sentiment_band,
  CASE WHEN rating <= 2 THEN 'negative' WHEN rating = 3 THEN 'neutral'
       ELSE 'positive' END AS rating_group
FROM one_product_reviews"""

VIEWS["social_buzz"] = """
SELECT *, CAST(likes AS BIGINT) + CAST(shares AS BIGINT) * 4 AS engagement_score,
  CAST(likes AS BIGINT) + CAST(shares AS BIGINT) * 4 > 200 AS is_viral,
  user_id IS NOT NULL AS has_user
FROM one_social_buzz"""

# -- metrics ---------------------------------------------------------------------------------

_HOUR = ("date_trunc('hour', event_ts) AS window_start,"
         " date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end")

VIEWS["hourly_sales"] = f"""
SELECT {_HOUR}, item_category AS category,
  CAST(round(sum(CAST(item_subtotal AS DECIMAL(20,4))), 2) AS DECIMAL(16,2)) AS gross_revenue,
  count(DISTINCT order_id) AS num_orders,
  count(*) FILTER (WHERE is_return) AS num_returns
FROM purchases WHERE payment_status = 'success' GROUP BY ALL"""

VIEWS["hourly_search_trends"] = f"""
SELECT {_HOUR}, lower(keyword) AS keyword, count(*) AS search_count,
  count(DISTINCT user_id) AS unique_visitors
FROM clickstream WHERE is_search AND keyword IS NOT NULL
GROUP BY date_trunc('hour', event_ts), lower(keyword) HAVING count(*) > 1"""

VIEWS["hourly_site_traffic"] = f"""
SELECT {_HOUR}, count(DISTINCT session_id) AS num_sessions,
  count(*) FILTER (WHERE event_type = 'view') AS num_clicks,
  count(*) FILTER (WHERE event_type = 'scroll') AS num_pageviews,
  count(DISTINCT user_id) AS unique_visitors,
  CAST({r('avg(dwell_ms)', 0)} AS BIGINT) AS avg_session_ms
FROM clickstream WHERE NOT is_bot GROUP BY ALL"""

VIEWS["sentiment_events"] = """
SELECT event_ts, sentiment_score, 'reviews' AS data_source FROM product_reviews
UNION ALL SELECT event_ts, sentiment_score, 'social_buzz' FROM social_buzz"""

VIEWS["hourly_sentiment"] = f"""
SELECT {_HOUR}, data_source,
  CAST({mean('sentiment_score', 4)} AS DECIMAL(7,4)) AS mean_sentiment,
  count(*) FILTER (WHERE sentiment_score >= 0.05) AS positive_cnt,
  count(*) FILTER (WHERE sentiment_score > -0.05 AND sentiment_score < 0.05) AS neutral_cnt,
  count(*) FILTER (WHERE sentiment_score <= -0.05) AS negative_cnt,
  count(*) AS total_cnt
FROM sentiment_events GROUP BY ALL"""

# -- segments --------------------------------------------------------------------------------

_ORDER_COLUMNS = "order_id, user_id, final_amount, event_ts, is_return, payment_status"


def _spend(source: str, where: str = "payment_status = 'success'") -> str:
    return f"""
SELECT user_id,
  CAST(round(sum(CAST(final_amount AS DECIMAL(20,4))), 2) AS DECIMAL(16,2)) AS revenue_30d,
  count(DISTINCT order_id) AS order_count_30d,
  CAST(max(event_ts) AS DATE) AS last_purchase_date,
  count(*) FILTER (WHERE is_return) AS ret_count
FROM {source} WHERE {where} GROUP BY user_id"""


VIEWS["order_rows"] = """
SELECT DISTINCT order_id, user_id, final_amount, event_ts, is_return, payment_status,
  payment_method, spend_band FROM purchases"""
VIEWS["user_spend"] = _spend("purchases")
VIEWS["user_spend_order"] = _spend("order_rows")
VIEWS["user_spend_30d"] = _spend(
    "purchases", f"""payment_status = 'success' AND event_ts <= {HORIZON_AS_OF}
  AND event_ts > {HORIZON_AS_OF} - INTERVAL 30 DAY""")
VIEWS["user_ratings"] = f"""
SELECT user_id, {r('avg(rating)', 2)} AS avg_review_score FROM product_reviews GROUP BY user_id"""


def _scored(spend: str) -> str:
    score = ("0.4::DOUBLE * (1 - order_count_30d / coalesce(nullif(CAST(max_orders AS DOUBLE), 0),"
             " 1))"
             " + 0.3::DOUBLE * (1 - CAST(revenue_30d AS DOUBLE) /"
             " coalesce(nullif(CAST(max_revenue AS DOUBLE), 0), 1))"
             " + 0.3::DOUBLE * (1 - coalesce(avg_review_score, 3.0::DOUBLE) / 5.0::DOUBLE)")
    return f"""
SELECT s.*, {r('(' + score + ')', 4)} AS churn_score,
  percent_rank() OVER (ORDER BY revenue_30d DESC) AS spend_rank
FROM (SELECT * FROM {spend} LEFT JOIN user_ratings USING (user_id)) s,
  (SELECT max(revenue_30d) AS max_revenue, max(order_count_30d) AS max_orders FROM {spend})"""


def _segments(scored: str, as_of: str) -> str:
    return f"""
SELECT {as_of} AS window_start, {as_of} AS window_end, user_id,
  CASE WHEN order_count_30d = 1 THEN 'new' WHEN churn_score > 0.65 THEN 'at_risk'
       WHEN spend_rank <= 0.20::DOUBLE THEN 'platinum' ELSE 'regular' END AS segment,
  revenue_30d, order_count_30d, last_purchase_date,
  CAST(avg_review_score AS DECIMAL(4,2)) AS avg_review_score,
  CAST(churn_score AS DECIMAL(6,4)) AS churn_score
FROM {scored}"""


for _suffix, _as_of in (("", AS_OF), ("_order", AS_OF), ("_30d", HORIZON_AS_OF)):
    VIEWS[f"user_scores{_suffix}"] = _scored(f"user_spend{_suffix}")
    VIEWS[f"user_segments{_suffix}"] = _segments(f"user_scores{_suffix}", _as_of)

# -- profiles --------------------------------------------------------------------------------


def _preferred(source: str, column: str, output: str, where: str) -> str:
    return f"""
SELECT user_id, {column} AS {output} FROM (
  SELECT user_id, {column}, row_number() OVER (
    PARTITION BY user_id ORDER BY count(*) DESC, {column}) AS rn
  FROM {source} WHERE {where} AND {column} IS NOT NULL GROUP BY user_id, {column})
WHERE rn = 1"""


_HUMAN = "user_id IS NOT NULL AND NOT is_bot"
VIEWS["preferred_payment"] = _preferred(
    "purchases", "payment_method", "preferred_payment", "user_id IS NOT NULL")
VIEWS["preferred_payment_order"] = _preferred(
    "order_rows", "payment_method", "preferred_payment", "user_id IS NOT NULL")
VIEWS["top_platform"] = _preferred("clickstream", "platform", "top_platform", _HUMAN)


def _profile_purchases(rows: str, preferred: str) -> str:
    return f"""
SELECT user_id, total_orders, coalesce(total_spent, 0) AS total_spent, total_returns,
  {r('(CAST(total_returns AS DOUBLE) / greatest(total_orders, 1))', 4)} AS return_rate,
  {iso('last_at')} AS last_purchase_at, preferred_payment, band_low, band_mid, band_high
FROM (SELECT user_id, count(DISTINCT order_id) AS total_orders,
        CAST(CAST(round(sum(CAST(final_amount AS DECIMAL(20,4))), 2) AS DECIMAL(16,2))
             AS DOUBLE) AS total_spent,
        count(*) FILTER (WHERE is_return) AS total_returns, max(event_ts) AS last_at,
        count(*) FILTER (WHERE spend_band = 'low') AS band_low,
        count(*) FILTER (WHERE spend_band = 'mid') AS band_mid,
        count(*) FILTER (WHERE spend_band = 'high') AS band_high
      FROM {rows} WHERE user_id IS NOT NULL GROUP BY user_id)
LEFT JOIN {preferred} USING (user_id)"""


VIEWS["profile_purchases"] = _profile_purchases("purchases", "preferred_payment")
VIEWS["profile_purchases_order"] = _profile_purchases("order_rows", "preferred_payment_order")

VIEWS["profile_reviews"] = f"""
SELECT user_id, coalesce({r('avg(rating)', 2)}, 0) AS avg_rating, count(*) AS total_reviews,
  coalesce({mean('sentiment_score', 4)}, 0) AS avg_sentiment,
  count(*) FILTER (WHERE sentiment_label = 'positive') AS positive,
  count(*) FILTER (WHERE sentiment_label = 'neutral') AS neutral,
  count(*) FILTER (WHERE sentiment_label = 'negative') AS negative
FROM product_reviews WHERE user_id IS NOT NULL GROUP BY user_id"""

VIEWS["profile_browsing"] = f"""
SELECT user_id, total_sessions, total_views, total_searches, total_cart_adds,
  {iso('last_at')} AS last_active_at, top_platform
FROM (SELECT user_id, count(DISTINCT session_id) AS total_sessions,
        count(*) FILTER (WHERE event_type = 'view') AS total_views,
        count(*) FILTER (WHERE is_search) AS total_searches,
        count(*) FILTER (WHERE is_checkout) AS total_cart_adds, max(event_ts) AS last_at
      FROM clickstream WHERE {_HUMAN} GROUP BY user_id)
LEFT JOIN top_platform USING (user_id)"""

VIEWS["profile_social"] = f"""
SELECT user_id, count(*) AS post_count, coalesce({mean('sentiment_score', 4)}, 0) AS avg_sentiment,
  coalesce({r('(CAST(sum(engagement_score) AS DOUBLE) / count(engagement_score))', 2)}, 0)
    AS avg_engagement,
  count(*) FILTER (WHERE is_viral) AS viral_posts,
  string_agg(DISTINCT platform, ',' ORDER BY platform) AS platforms
FROM social_buzz WHERE user_id IS NOT NULL GROUP BY user_id"""

VIEWS["user_profiles"] = f"""
SELECT user_id, {AS_OF} AS updated_at,
  p.total_orders AS purchases_total_orders, p.total_spent AS purchases_total_spent,
  p.total_returns AS purchases_total_returns, p.return_rate AS purchases_return_rate,
  p.last_purchase_at AS purchases_last_purchase_at,
  p.preferred_payment AS purchases_preferred_payment, p.band_low AS purchases_low,
  p.band_mid AS purchases_mid, p.band_high AS purchases_high,
  v.avg_rating AS reviews_avg_rating, v.total_reviews AS reviews_total_reviews,
  v.avg_sentiment AS reviews_avg_sentiment, v.positive AS reviews_positive,
  v.neutral AS reviews_neutral, v.negative AS reviews_negative,
  b.total_sessions AS browsing_total_sessions, b.total_views AS browsing_total_views,
  b.total_searches AS browsing_total_searches, b.total_cart_adds AS browsing_total_cart_adds,
  b.last_active_at AS browsing_last_active_at, b.top_platform AS browsing_top_platform,
  s.post_count AS social_post_count, s.avg_sentiment AS social_avg_sentiment,
  s.avg_engagement AS social_avg_engagement, s.viral_posts AS social_viral_posts,
  s.platforms AS social_platforms,
  coalesce(g.segment, 'unknown') AS segment_label,
  coalesce(CAST(g.churn_score AS DOUBLE), 0) AS segment_churn_score,
  coalesce(CAST(g.revenue_30d AS DOUBLE), 0) AS segment_revenue_30d,
  coalesce(g.order_count_30d, 0) AS segment_order_count_30d,
  CAST(g.last_purchase_date AS VARCHAR) AS segment_last_purchase_date,
  coalesce(CAST(g.avg_review_score AS DOUBLE), 0) AS segment_avg_review_score
FROM profile_purchases p FULL JOIN profile_reviews v USING (user_id)
  FULL JOIN profile_browsing b USING (user_id) FULL JOIN profile_social s USING (user_id)
  FULL JOIN user_segments g USING (user_id)"""

VIEWS["risk"] = """
SELECT user_id, segment, churn_score, revenue_30d, order_count_30d, last_purchase_date,
  avg_review_score
FROM user_segments WHERE churn_score >= 0.5 AND segment IN ('at_risk', 'regular')"""
VIEWS["units"] = "SELECT CAST(churn_score * 10000 AS BIGINT) AS u FROM risk"


def sql(statement: str) -> str:
    """The statement with the sub-queries it needs, in an order in which they can be read."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text) and name not in needed:
                visit(VIEWS[name])
                needed.append(name)

    visit(statement)
    if not needed:
        return statement.strip()
    body = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    return f"WITH {body}\n{statement.strip()}"


# -- statements ------------------------------------------------------------------------------

def _all(view: str, leave_out: str = "") -> str:
    return f"SELECT * {f'EXCLUDE ({leave_out}) ' if leave_out else ''}FROM {view}"


def _title(column: str) -> str:
    return (f"array_to_string(list_transform(string_split(replace({column}, '_', ' '), ' '),"
            " lambda w: upper(w[1]) || lower(w[2:])), ' ')")


_PROFILE_LATER = f"""
SELECT * REPLACE (CASE WHEN user_id LIKE '%3' THEN {AS_OF}
                       ELSE TIMESTAMP '2001-12-01 00:00:00' END AS updated_at)
FROM user_profiles"""

def _lexicon_rows() -> str:
    from tierlake.operators.sentiment import VALENCE

    return ", ".join(f"('{w}', {v})" for v, words in VALENCE.items() for w in words.split())


_SCORED = f"""
SELECT doc_id, hits, score AS sentiment_score,
  CASE WHEN score >= 0.05 THEN 'positive' WHEN score <= -0.05 THEN 'negative' ELSE 'neutral' END
    AS sentiment_label
FROM (SELECT doc_id, hits, {r('(s / sqrt(CAST(s * s + 15 AS DOUBLE)))', 4)} AS score
      FROM (SELECT doc_id, count(valence) AS hits, coalesce(sum(valence), 0) AS s
            FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^a-z]+')) AS word
                  FROM documents)
            LEFT JOIN (VALUES {{lexicon}}) AS l(word, valence) USING (word)
            GROUP BY doc_id))"""


def _per_date(tables: str, prefix: str, measure: str) -> str:
    """Rows and a measure of tables that were loaded on one date."""
    parts = (f"SELECT '{t}' AS \"table\", CAST({AS_OF} AS DATE) AS ingestion_date,"
             f" count(*) AS n, {measure} FROM {prefix}{t}" for t in tables.split())
    return " UNION ALL ".join(parts)


# E-mail address, IPv4 address, telephone number.
_PERSONAL = (
    (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "<email>"),
    (r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\b", "<ip>"),
    (r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}", "<phone>"))
_TOPIC_TABLES = "clickstream purchases product_reviews social_buzz"


# Fields of a profile document by section: n whole number, d decimal, s text, a list of texts.
_DOCUMENT = {
    "purchases": "total_orders:n total_spent:d total_returns:n return_rate:d last_purchase_at:s "
                 "preferred_payment:s spend_distribution(low:n mid:n high:n)",
    "reviews": "avg_rating:d total_reviews:n avg_sentiment:d "
               "breakdown(positive:n neutral:n negative:n)",
    "browsing": "total_sessions:n total_views:n total_searches:n total_cart_adds:n "
                "last_active_at:s top_platform:s",
    "social": "post_count:n avg_sentiment:d avg_engagement:d viral_posts:n platforms:a",
    "segment": "label:s churn_score:d revenue_30d:d order_count_30d:n last_purchase_date:s "
               "avg_review_score:d",
}


def _document() -> str:
    """The profile documents as text, put together from the flattened profiles."""
    def value(section: str, field: str) -> str:
        name, kind = field.split(":")
        column = f"{section}_{name}"
        text = {"n": f"CAST({column} AS VARCHAR)",
                "d": f"CAST(CAST({column} AS DECIMAL(20,4)) AS VARCHAR)",
                "s": f"'\"' || {column} || '\"'",
                "a": f"'[\"' || replace({column}, ',', '\",\"') || '\"]'"}[kind]
        return f"'\"{name}\":' || {text}"

    def body(section: str, fields: str) -> str:
        flat, _, nested = fields.partition("(")
        names = flat.split()
        values = [value(section, f) for f in (names[:-1] if nested else names)]
        if nested:
            inner = ", ".join(value(section, f) for f in nested.rstrip(")").split())
            values.append(f"'\"{names[-1]}\":{{' || concat_ws(',', {inner}) || '}}'")
        first = names[0].split(":")[0]
        return (f"CASE WHEN {section}_{first} IS NOT NULL THEN '\"{section}\":{{' || "
                f"concat_ws(',', {', '.join(values)}) || '}}' END")

    sections = ", ".join(body(s, f) for s, f in _DOCUMENT.items())
    return f"""SELECT user_id, '{{' || concat_ws(',', '\"user_id\":\"' || user_id || '\"',
        {sections}) || '}}' AS document FROM user_profiles"""


def statements() -> dict[str, str]:
    def masked(column: str) -> str:
        for pattern, tag in _PERSONAL:
            column = f"regexp_replace({column}, '{pattern}', '{tag}', 'g')"
        return column

    scored = _SCORED.replace("{lexicon}", _lexicon_rows())
    price = "CAST(CAST(item_unit_price AS DECIMAL(20,4)) * item_qty AS DECIMAL(38,4))"

    out = {
        # sources
        "ingest_topic_batch": _all("raw_product_reviews", "o_orderkey"),
        "ingest_topic_stream": f"""
            SELECT * EXCLUDE (o_orderkey) REPLACE ({AS_OF} AS ingested_at,
                                                   CAST({AS_OF} AS DATE) AS ingestion_date)
            FROM raw_product_reviews""",
        "stream_raw_to_parquet": _all("raw_clickstream"),
        "parse_clickstream": _all("raw_clickstream"),
        "parse_purchases": """
            SELECT p.* EXCLUDE (o_orderkey), coalesce(n_items, 0) AS n_items,
              coalesce(items, '') AS items
            FROM raw_purchases p LEFT JOIN items_text i USING (o_orderkey)""",
        "parse_reviews": _all("raw_product_reviews", "o_orderkey"),
        "parse_social": _all("raw_social_buzz", "event_id"),
        "parse_quarantine": """
            SELECT topic, "partition", "offset", kafka_ts,
              CASE WHEN "offset" % 61 = 0 OR "offset" % 67 = 0 THEN 'malformed'
                   WHEN "offset" % 71 = 0 THEN 'bad_timestamp' ELSE 'no_value' END AS reason
            FROM raw_clickstream WHERE "offset" % 61 = 0 OR "offset" % 67 = 0
              OR "offset" % 71 = 0 OR "offset" % 73 = 0""",
        "scan_parquet": """
            SELECT * FROM raw_clickstream
            WHERE ingestion_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-19'""",
        # sinks
        "write_partitioned": """
            SELECT ingestion_date, count(*) AS n,
              CAST(sum(CASE WHEN ingestion_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-07'
                       THEN 0 ELSE dwell_ms END) AS BIGINT) AS dwell_ms
            FROM raw_clickstream GROUP BY ingestion_date""",
        "upsert_profiles": _PROFILE_LATER,
        "conform_metrics": f"""
            SELECT * REPLACE (CASE WHEN total_cnt > 1 THEN mean_sentiment
                              ELSE CAST(0 AS DECIMAL(7,4)) END AS mean_sentiment), {AS_OF} AS created_at
            FROM hourly_sentiment""",
        "contract_violations": """
            SELECT c || ' not null' AS rule,
              CASE WHEN c = 'category' THEN (SELECT count(*) FROM hourly_sales
                                             WHERE num_orders = 2) ELSE 0 END AS violations
            FROM (VALUES ('window_start'), ('window_end'), ('category'), ('gross_revenue'),
                         ('num_orders'), ('num_returns')) AS t(c)""",
        "pk_violations": """
            SELECT order_id, count(*) AS copies FROM raw_purchases
            GROUP BY order_id HAVING count(*) > 1""",
        "profile_validation": """
            SELECT user_id FROM user_profiles WHERE browsing_total_sessions IS NULL""",
        "layer_audit": " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", (SELECT count(*) FROM raw_{t}) AS rows_in,"
            f" (SELECT count(*) FROM {t}) AS rows_out" for t in _TOPIC_TABLES.split()),
        # clean
        "dedup_clickstream": _all("one_clickstream"),
        "dedup_purchases": _all("one_purchases", "o_orderkey"),
        "dedup_reviews": _all("one_product_reviews", "o_orderkey"),
        "dedup_social": """SELECT post_id, user_id, platform, content, likes, shares, "offset",
            ingested_at FROM one_social_buzz""",
        "clean_clickstream": _all("clickstream"),
        "clean_purchases": _all("purchases", "o_orderkey"),
        "clean_reviews": _all("product_reviews", "o_orderkey"),
        "clean_social": _all("social_buzz", "event_id"),
        "explode_items": """
            SELECT order_id, "offset", i.* EXCLUDE (o_orderkey)
            FROM raw_purchases p JOIN order_items i USING (o_orderkey)""",
        "spend_band": """
            SELECT "offset", amount, CASE WHEN amount < 500 THEN 'low' WHEN amount < 2500
              THEN 'mid' ELSE 'high' END AS spend_band
            FROM (SELECT "offset", CASE WHEN "offset" % 50 <> 1 THEN final_amount / 100 END
                  AS amount FROM raw_purchases)""",
        "sentiment_band": """
            SELECT "offset", score, CASE WHEN score >= 0.5 THEN 'very_positive'
              WHEN score >= 0.05 THEN 'positive' WHEN score > -0.05 THEN 'neutral'
              WHEN score > -0.5 THEN 'negative' ELSE 'very_negative' END AS sentiment_band
            FROM (SELECT "offset", CASE WHEN "offset" % 50 <> 1 THEN sentiment_score END
                  AS score FROM raw_social_buzz)""",
        "rating_group": """
            SELECT "offset", rating, CASE WHEN rating <= 2 THEN 'negative' WHEN rating = 3
              THEN 'neutral' ELSE 'positive' END AS rating_group
            FROM (SELECT "offset", CASE WHEN "offset" % 50 <> 1 THEN rating END AS rating
                  FROM raw_product_reviews)""",
        "engagement_score": """
            SELECT "offset", likes, shares,
              CAST(likes AS BIGINT) + CAST(shares AS BIGINT) * 4 AS engagement_score,
              CAST(likes AS BIGINT) + CAST(shares AS BIGINT) * 4 > 200 AS is_viral
            FROM raw_social_buzz""",
        "mask_pii": f"SELECT doc_id, {masked('text')} AS text FROM documents",
        "mask_click_identity": r"""
            SELECT "offset", regexp_replace(ip,
                '^([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})\.[0-9]{1,3}$', '\1.x') AS ip,
              sha256('salt:' || user_id) AS user_digest
            FROM raw_clickstream""",
        "clean_reviews_masked": f"""
            SELECT review_id, sha256('salt:' || user_id) AS user_id,
              {masked('review_text')} AS review_text FROM product_reviews""",
        "score_sentiment": scored,
        "sentiment_label": f"SELECT sentiment_label, count(*) AS n FROM ({scored}) GROUP BY 1",
        "order_amount_check": f"""
            SELECT order_id, CAST(coalesce(n_items, 0) AS INT) AS n_items,
              CAST(coalesce(bad_items, 0) AS INT) AS bad_items,
              CAST(round(total, 2) AS DOUBLE) AS computed_total, total_amount,
              CAST(CAST(cents AS DECIMAL(38,2)) / 100 AS DOUBLE) AS computed_final, final_amount,
              abs(CAST(round(total, 2) AS DOUBLE) - total_amount) < 0.005 AS total_ok,
              abs(CAST(CAST(cents AS DECIMAL(38,2)) / 100 AS DOUBLE) - final_amount) < 0.005
                AS final_ok
            FROM (SELECT *, (CAST(total * 10000 AS BIGINT)
                             * (100 - CAST(discount_pct AS BIGINT)) + 5000) // 10000 AS cents
                  FROM (SELECT p.*, n_items, bad_items, coalesce(t, 0) AS total
                        FROM one_purchases p LEFT JOIN (
                          SELECT o_orderkey, count(*) AS n_items,
                            count(*) FILTER (WHERE abs(round({price}, 2)
                              - CAST(item_subtotal AS DECIMAL(20,4))) >= 0.01) AS bad_items,
                            sum(CAST(item_subtotal AS DECIMAL(20,4))) AS t
                          FROM order_items GROUP BY 1) USING (o_orderkey)))""",
        # metrics
        **{m: _all(m) for m in ("hourly_sales", "hourly_search_trends", "hourly_site_traffic",
                                "hourly_sentiment")},
        "distinct_approx": """
            SELECT platform, count(DISTINCT user_id) AS users, true AS users_close,
              count(DISTINCT session_id) AS sessions, true AS sessions_close
            FROM clickstream GROUP BY platform""",
        "distinct_exact": """
            SELECT platform, count(DISTINCT user_id) AS users,
              count(DISTINCT session_id) AS sessions FROM clickstream GROUP BY platform""",
        # segments
        "user_spend": _all("user_spend"),
        "user_ratings": _all("user_ratings"),
        "spend_percent_rank": "SELECT user_id, revenue_30d, spend_rank FROM user_scores",
        "churn_score": "SELECT user_id, churn_score FROM user_scores",
        "user_segments": _all("user_segments"),
        "user_segments_order_grain": _all("user_segments_order"),
        "user_segments_30d": _all("user_segments_30d"),
        # profiles
        **{p: _all(p) for p in ("profile_purchases", "profile_reviews", "profile_browsing",
                                "profile_social", "preferred_payment", "top_platform",
                                "user_profiles")},
        "profile_purchases_order_grain": _all("profile_purchases_order"),
        "profile_keys": " UNION ".join(
            f"SELECT user_id FROM {t} WHERE user_id IS NOT NULL" for t in _TOPIC_TABLES.split()),
        "profiles_limited": "SELECT * FROM user_profiles ORDER BY user_id LIMIT 50",
        # read queries
        "kpi_sales": f"""
            SELECT revenue, orders, returns,
              coalesce({r('(100.0::DOUBLE * returns / nullif(orders, 0))', 1)}, 0)
                AS return_rate_pct
            FROM (SELECT CAST(sum(gross_revenue) AS DECIMAL(26,2)) AS revenue,
                    CAST(sum(num_orders) AS BIGINT) AS orders,
                    CAST(sum(num_returns) AS BIGINT) AS returns FROM hourly_sales)""",
        "kpi_traffic": f"""
            SELECT CAST(sum(num_sessions) AS BIGINT) AS sessions,
              CAST(sum(unique_visitors) AS BIGINT) AS visitors,
              {r('(avg(avg_session_ms) / 1000)', 1)} AS avg_session_s
            FROM hourly_site_traffic""",
        "segment_counts": "SELECT segment, count(*) AS cnt FROM user_segments GROUP BY 1",
        "segment_share": f"""
            SELECT segment, {_title('segment')} AS title, cnt,
              CAST(round(cnt * 100.0 / sum(cnt) OVER (), 1) AS DOUBLE) AS share_pct
            FROM (SELECT segment, count(*) AS cnt FROM user_segments GROUP BY 1)""",
        "revenue_by_category": """
            SELECT category, CAST(sum(gross_revenue) AS DECIMAL(26,2)) AS revenue,
              CAST(sum(num_orders) AS BIGINT) AS orders FROM hourly_sales GROUP BY 1""",
        "traffic_series": """SELECT window_start, num_sessions, num_clicks, num_pageviews,
            unique_visitors FROM hourly_site_traffic""",
        "top_keywords": f"""
            SELECT *, {r('(CAST(total_searches AS DOUBLE) / total_users)', 2)}
              AS searches_per_user
            FROM (SELECT keyword, CAST(sum(search_count) AS BIGINT) AS total_searches,
                    CAST(sum(unique_visitors) AS BIGINT) AS total_users
                  FROM hourly_search_trends WHERE search_count >= 2 GROUP BY 1
                  ORDER BY 2 DESC, 1 LIMIT 20)""",
        "sentiment_breakdown": f"""
            SELECT window_start, data_source, {_title('data_source')} AS title, score,
              CASE WHEN score > 0.05 THEN 'positive' WHEN score > -0.05 THEN 'neutral'
                   ELSE 'negative' END AS mood,
              {r('(positive_cnt * 100.0::DOUBLE / total_cnt)', 1)} AS positive_pct,
              {r('(neutral_cnt * 100.0::DOUBLE / total_cnt)', 1)} AS neutral_pct,
              {r('(negative_cnt * 100.0::DOUBLE / total_cnt)', 1)} AS negative_pct
            FROM (SELECT *, {r('CAST(mean_sentiment AS DOUBLE)', 3)} AS score
                  FROM hourly_sentiment)""",
        "profile_sentiment": f"""
            SELECT {r('avg(reviews_avg_sentiment)', 3)} AS avg_review_sentiment,
              {r('avg(social_avg_sentiment)', 3)} AS avg_social_sentiment,
              count(*) AS profiles
            FROM user_profiles WHERE reviews_avg_sentiment IS NOT NULL""",
        "user_profiles_nested": _document(),
        "recent_profiles": """
            SELECT user_id, segment_label AS segment, updated_at FROM user_profiles
            ORDER BY updated_at DESC, user_id LIMIT 5""",
        "profile_lookup": """
            SELECT *, CASE WHEN segment_churn_score > 0.65 THEN 'red'
              WHEN segment_churn_score > 0.4 THEN 'yellow' ELSE 'green' END AS churn_level
            FROM user_profiles WHERE user_id = 'USR-000042'""",
        "live_risk_count": """
            SELECT count(*) AS profiles,
              count(*) FILTER (WHERE segment_churn_score >= 0.5) AS at_risk
            FROM user_profiles""",
        "churn_risk_users": "SELECT * FROM risk ORDER BY churn_score DESC, user_id LIMIT 50",
        "churn_risk_summary": f"""
            SELECT count(*) AS matching, {r('avg(CAST(churn_score AS DOUBLE))', 4)} AS avg_churn,
              {r('avg(CAST(revenue_30d AS DOUBLE))', 2)} AS avg_revenue FROM risk""",
        "churn_histogram": f"""
            SELECT bin, {r('((lo + (hi - lo) * (bin - 1) / 10.0::DOUBLE) / 10000)', 6)} AS lower,
              {r('((lo + (hi - lo) * bin / 10.0::DOUBLE) / 10000)', 6)} AS upper,
              (SELECT count(*) FROM units u WHERE bin = greatest(1, CAST(
                 ceil((u.u - lo) * 10 / CAST(greatest(hi - lo, 1) AS DOUBLE)) AS INT))) AS n
            FROM (SELECT CAST(range AS INT) AS bin FROM range(1, 11)),
              (SELECT min(u) AS lo, max(u) AS hi FROM units)""",
        "churn_scatter": "SELECT user_id, revenue_30d, churn_score, segment FROM risk",
        "scalar_functions": f"""
            SELECT "offset", page AS text_of_bytes, CAST("offset" AS INT) AS as_int,
              CAST(dwell_ms AS BIGINT) AS as_long,
              CAST(dwell_ms / 100.0::DOUBLE AS DECIMAL(16,2)) AS as_decimal,
              CAST("offset" AS INT) AS json_k, event_ts AS ts, true AS bad_ts_is_null,
              CAST(event_ts AS DATE) AS day, CAST(hour(event_ts) AS INT) AS hour,
              CAST(dayofweek(event_ts) + 1 AS INT) AS weekday,
              date_trunc('hour', event_ts) AS window_start,
              date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end,
              lower(keyword) AS lowered, {_title('event_type')} AS title, user_id AS trimmed,
              {r('(CAST(dwell_ms AS DOUBLE) / 7)', 2)} AS seventh,
              {r('(CAST("offset" AS DOUBLE) / nullif("offset" % 4, 0))', 2)} AS guarded,
              CASE WHEN dwell_ms < 500 THEN 'short' ELSE 'long' END AS length,
              coalesce(keyword, 'none') AS keyword_or_none,
              event_type IN ('view', 'scroll') AS is_reading, NOT (dwell_ms < 120) AS not_bot,
              keyword IS NOT NULL AND event_type = 'search' AS searched,
              least(platform, traffic_src) AS first_of_two
            FROM raw_clickstream""",
        # jobs
        "job_raw": _per_date(_TOPIC_TABLES, "raw_", 'max("offset") AS last_offset'),
        "job_clean": _per_date(_TOPIC_TABLES, "", 'CAST(sum("offset") AS BIGINT) AS offsets'),
        "job_metrics": " UNION ALL ".join(
            f"SELECT '{m}' AS \"table\", count(*) AS n, count(DISTINCT window_start) AS windows"
            f" FROM {m}" for m in ("hourly_sales", "hourly_search_trends",
                                   "hourly_site_traffic", "hourly_sentiment",
                                   "user_segments")),
        "job_full": _all("hourly_sales"),
        "job_incremental": _all("hourly_sales"),
        "job_profiles": _all("user_profiles"),
        # streams
        "stream_clean_clickstream": _all("clickstream"),
        "stream_clean_purchases": _all("purchases", "o_orderkey"),
        "stream_clean_reviews": _all("product_reviews", "o_orderkey"),
        "stream_clean_social": _all("social_buzz", "event_id"),
        "stream_clean_reviews_masked": f"""
            SELECT review_id, sha256('salt:' || user_id) AS user_id,
              {masked('review_text')} AS review_text FROM product_reviews""",
        **{f"stream_{m}": _all(m) for m in ("hourly_sales", "hourly_search_trends",
                                            "hourly_site_traffic", "hourly_sentiment")},
        "stream_upsert_metrics": _all("hourly_sentiment"),
        "stream_late_data": "SELECT * FROM hourly_sentiment WHERE data_source = 'social_buzz'",
        "stream_profile_refresh": _all("user_profiles"),
    }
    return {name: sql(text) for name, text in out.items()}
