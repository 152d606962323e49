"""Bands and flags. A null input falls through to the last branch of a band, as the source data
contract has it; flags of a null input stay null.

The cut points and labels are fixed values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

BOT_DWELL_MS = 120
VIRAL_SCORE = 200
SHARE_WEIGHT = 4
POSITIVE_FROM = 0.05
NEGATIVE_FROM = -0.05


def _first_match(cases: list[tuple[Column, str]], default: str) -> Column:
    (head, label), *rest = cases
    return reduce(lambda acc, c: acc.when(*c), rest, F.when(head, label)).otherwise(default)


def spend_band(amount: str = "final_amount") -> Column:
    """low under 500, mid under 2500, otherwise high (also null)."""
    return _first_match([(F.col(amount) < 500, "low"), (F.col(amount) < 2500, "mid")], "high")


def sentiment_band(score: str = "sentiment_score") -> Column:
    """Five bands cut at 0.5, 0.05, -0.05 and -0.5; null is very_negative."""
    s = F.col(score)
    return _first_match(
        [(s >= 0.5, "very_positive"), (s >= POSITIVE_FROM, "positive"),
         (s > NEGATIVE_FROM, "neutral"), (s > -0.5, "negative")],
        "very_negative",
    )


def rating_group(rating: str = "rating") -> Column:
    """negative up to 2, neutral at 3, otherwise positive (also null)."""
    r = F.col(rating)
    return _first_match([(r <= 2, "negative"), (r == 3, "neutral")], "positive")


def sentiment_label(score: str = "sentiment_score") -> Column:
    """positive from 0.05, negative from -0.05 down, otherwise neutral; null stays null."""
    s = F.col(score)
    return F.when(s >= POSITIVE_FROM, "positive").when(s <= NEGATIVE_FROM, "negative").when(
        s.isNotNull(), "neutral")


def engagement_score(likes: str = "likes", shares: str = "shares") -> Column:
    """likes + 4 * shares, widened to bigint so that large counts cannot overflow an int."""
    return F.col(likes).cast("long") + F.col(shares).cast("long") * SHARE_WEIGHT


def churn_level(score: Column) -> Column:
    """Traffic-light level of a churn score: red over 0.65, yellow over 0.4, else green."""
    return F.when(score > 0.65, "red").when(score > 0.4, "yellow").otherwise("green")
