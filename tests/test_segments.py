import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window, functions as F

from tests.rows import at, item, order, raw, review, tuples
from tierlake.operators import segments
from tierlake.operators.clean import clean_topic
from tierlake.operators.ranking import (count_larger, percent_rank_desc, top_share_cutoff,
                                          value_counts)
from tierlake.plans import serving

AS_OF = datetime(2024, 6, 1)


def _values(kind, n=400, seed=3):
    rng = random.Random(seed)
    make = {
        "ties": lambda: rng.randrange(12),
        "spread": lambda: rng.randrange(-10**15, 10**15),
        "near": lambda: 2**36 + rng.randrange(-3, 3) * 2**18 + rng.randrange(2),
        "nulls": lambda: rng.choice([None, 1, 2, rng.randrange(10**12)]),
        "hot": lambda: 0 if rng.random() < 0.4 else rng.randrange(10**9),
    }[kind]
    return [(i, make()) for i in range(n)]


@pytest.mark.parametrize("kind", ["ties", "spread", "near", "nulls", "hot"])
def test_percent_rank_equals_the_window_function(spark, kind):
    df = spark.createDataFrame(_values(kind), "i int, v long")
    expected = df.withColumn("r", F.percent_rank().over(Window.orderBy(F.col("v").desc())))
    assert tuples(percent_rank_desc(df, "v", "r"), "i", "r") == tuples(expected, "i", "r")


@pytest.mark.parametrize("kind", ["ties", "spread", "near", "hot"])
@pytest.mark.parametrize("share", [0.0, 0.2, 1.0])
def test_cutoff_marks_the_same_rows_as_percent_rank(spark, kind, share):
    df = spark.createDataFrame(_values(kind, 101), "i int, v long")
    ranked = df.withColumn("r", F.percent_rank().over(Window.orderBy(F.col("v").desc())))
    cutoff = top_share_cutoff(df, "v", share).first()[0]
    assert tuples(df.filter(F.col("v") >= cutoff), "i") == tuples(
        ranked.filter(F.col("r") <= share), "i")


def test_count_larger_by_brute_force(spark):
    values = _values("spread", 60) + [(99, -5), (100, -5), (101, 0)]
    got = count_larger(value_counts(spark.createDataFrame(values, "i int, v long"), "v"),
                       "v").collect()
    plain = [v for _, v in values]
    assert {(r["v"], r["n"], r["n_larger"]) for r in got} == {
        (v, plain.count(v), sum(w > v for w in plain)) for v in plain}


@pytest.mark.parametrize("rows", [[], [(1, 5)], [(1, None)], [(1, 7), (2, 7)]])
def test_ranks_of_tiny_tables(spark, rows):
    df = spark.createDataFrame(rows, "i int, v long")
    assert tuples(percent_rank_desc(df, "v", "r"), "i", "r") == [(i, 0.0) for i, _ in rows]


def _purchases(spark, *orders):
    return clean_topic(raw(spark, "purchases", *orders), "purchases")


def _reviews(spark, *rows):
    return clean_topic(raw(spark, "product_reviews", *rows), "product_reviews")


def _by_user(df):
    return {r["user_id"]: r for r in df.collect()}


def test_segment_rules_in_order(spark):
    orders = [order(f"b{i}", "big", 100.0) for i in range(10)]
    orders += [order(f"m{i}", "mid", 50.0) for i in range(6)]
    orders += [order(f"s{i}", "small", 1.0) for i in range(2)]
    orders += [order("one", "new", 5000.0), order("f", "failed", payment_status="failed")]
    rows = _by_user(segments.user_segments(
        _purchases(spark, *orders), _reviews(spark, review(user="big", rating=4)), AS_OF))
    assert set(rows) == {"big", "mid", "small", "new"}
    assert rows["new"]["segment"] == "new"
    assert rows["small"]["segment"] == "at_risk"
    assert rows["mid"]["segment"] == "regular"
    assert rows["big"]["avg_review_score"] == Decimal("4.00")
    assert rows["small"]["avg_review_score"] is None
    # 0.4 * (1 - 2/10) + 0.3 * (1 - 2/5000) + 0.3 * (1 - 3/5)
    assert rows["small"]["churn_score"] == Decimal("0.7399")
    assert {r["window_start"] for r in rows.values()} == {AS_OF}


def test_top_fifth_is_platinum(spark):
    orders = [order(f"{u}-{i}", f"u{u}", 100.0 + u) for u in range(11) for i in range(4)]
    rows = _by_user(segments.user_segments(_purchases(spark, *orders), _reviews(spark), AS_OF))
    assert {u for u, r in rows.items() if r["segment"] == "platinum"} == {"u8", "u9", "u10"}


def test_single_user_is_new_and_two_orders_platinum(spark):
    one = segments.user_segments(_purchases(spark, order("a")), _reviews(spark), AS_OF)
    assert tuples(one, "segment") == ["new"]
    two = segments.user_segments(_purchases(spark, order("a"), order("b")), _reviews(spark),
                                 AS_OF)
    assert tuples(two, "segment") == ["platinum"]


def test_grain(spark):
    df = _purchases(spark, order("a", amount=10.0, items=[item(), item(), item()],
                                 is_return=True))
    assert tuples(segments.user_spend(df), "revenue_30d", "ret_count") == [(Decimal("30.00"), 3)]
    assert tuples(segments.user_spend(df, segments.ORDER), "revenue_30d", "ret_count") == [
        (Decimal("10.00"), 1)]
    with pytest.raises(ValueError):
        segments.user_spend(df, "month")


def test_horizon(spark):
    end = at(0)
    df = _purchases(spark, order("in", event_ts=at(-29 * 24 * 60)), order("now", event_ts=end),
                    order("edge", event_ts=at(-30 * 24 * 60)), order("later", event_ts=at(1)))
    spend = segments.user_spend(df, horizon_days=30, as_of=end)
    assert tuples(spend, "order_count_30d") == [2]
    assert tuples(segments.user_spend(df), "order_count_30d") == [4]


def test_zero_revenue_does_not_divide_by_zero(spark):
    df = _purchases(spark, order("a", amount=0.0), order("b", amount=0.0))
    scored = segments.score_churn(segments.user_stats(df, _reviews(spark)))
    # 0.4 * 0 + 0.3 * 1 + 0.3 * (1 - 3/5)
    assert tuples(scored, "churn_score") == [0.42]


def _risk_rows(spark, *scores):
    return spark.createDataFrame(
        [(f"u{i}", "at_risk", Decimal(s), Decimal("1.00"), 1, None, None)
         for i, s in enumerate(scores)],
        "user_id string, segment string, churn_score decimal(6,4), revenue_30d decimal(16,2),"
        " order_count_30d long, last_purchase_date date, avg_review_score decimal(4,2)")


def test_risk_list_filters(spark):
    df = _risk_rows(spark, "0.5", "0.4999", "0.9", "0.9")
    assert [r[0] for r in serving.churn_risk_users(df).collect()] == ["u2", "u3", "u0"]
    assert serving.churn_risk_users(df, only=["new"]).count() == 0
    assert serving.churn_risk_users(df, 0.0, [], 2).count() == 2


@pytest.mark.parametrize("scores, expected", [
    (["0.5", "0.5", "0.5"], [3] + [0] * 9),
    (["0.0", "0.1", "0.1001", "1.0"], [2, 1] + [0] * 7 + [1]),
    ([], [0] * 10),
])
def test_histogram_bins(spark, scores, expected):
    rows = serving.churn_histogram(_risk_rows(spark, *scores)).collect()
    assert [r["bin"] for r in rows] == list(range(1, 11))
    assert [r["n"] for r in rows] == expected


def test_users_without_revenue_can_be_the_top_fifth(spark):
    """percent_rank of a table of nulls is zero for every row."""
    nulls = spark.createDataFrame([(i, None) for i in range(4)], "i int, v long")
    assert tuple(top_share_cutoff(nulls, "v", 0.2).first()) == (None, True)
    some = spark.createDataFrame([(i, i if i < 3 else None) for i in range(8)], "i int, v long")
    assert tuple(top_share_cutoff(some, "v", 0.2).first()) == (1, False)
