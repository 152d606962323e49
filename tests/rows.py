"""Small hand-written tables."""

from __future__ import annotations

from datetime import datetime, timedelta

from tierlake.schemas import TOPICS

DAY = datetime(2024, 3, 9, 10, 0)  # a Saturday


def at(minutes: float) -> datetime:
    return DAY + timedelta(minutes=minutes)


def raw(spark, folder, *rows, **defaults):
    """Raw rows of a topic from dicts; offsets count up, times default to DAY."""
    schema = TOPICS[folder].raw
    full = []
    for i, row in enumerate(rows):
        values = {"topic": TOPICS[folder].name, "partition": 0, "offset": i, "kafka_ts": DAY,
                  "event_ts": DAY, "ingested_at": DAY, **defaults, **row}
        values.setdefault("ingestion_date", values["ingested_at"].date())
        full.append(tuple(values.get(n) for n in schema.names))
    return spark.createDataFrame(full, schema)


def click(session="s", user="u", event="view", **more):
    return {"session_id": session, "user_id": user, "event_type": event, "dwell_ms": 500, **more}


def item(category="c", subtotal=10.0, qty=1, sku="k"):
    return (sku, "t", category, qty, subtotal / qty, subtotal)


def order(order_id="o", user="u", amount=10.0, items=None, **more):
    return {"order_id": order_id, "user_id": user, "final_amount": amount,
            "total_amount": amount, "discount_pct": 0.0, "payment_status": "success",
            "payment_method": "card", "is_return": False,
            "items": [item()] if items is None else items, **more}


def review(review_id="r", user="u", rating=5, score=0.5, **more):
    return {"review_id": review_id, "user_id": user, "rating": rating, "sentiment_score": score,
            "sentiment_label": "positive", **more}


def post(post_id="p", user="u", likes=1, shares=0, score=0.5, **more):
    return {"post_id": post_id, "user_id": user, "likes": likes, "shares": shares,
            "sentiment_score": score, "platform": "twitter", **more}


def tuples(df, *columns):
    """Rows as a sorted list of tuples, or of plain values for one column."""
    rows = df.select(*columns).collect() if columns else df.collect()
    out = [r[0] if len(r) == 1 else tuple(r) for r in rows]
    return sorted(out, key=str)
