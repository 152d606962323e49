import pytest
from pyspark.sql import functions as F

from tests.rows import tuples
from tierlake.functions import bands, privacy
from tierlake.functions.numeric import money_sum, ratio, score_mean
from tierlake.functions.text import iso_text, title_text


def _apply(spark, values, kind, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column("x")).collect()]


@pytest.mark.parametrize("values, kind, column, expected", [
    ([499.99, 500.0, 2499.99, 2500.0, None], "double", bands.spend_band,
     ["low", "mid", "mid", "high", "high"]),
    ([0.5, 0.05, 0.0499, -0.05, -0.5, None], "double", bands.sentiment_band,
     ["very_positive", "positive", "neutral", "negative", "very_negative", "very_negative"]),
    ([2, 3, 4, None], "int", bands.rating_group, ["negative", "neutral", "positive", "positive"]),
    ([0.05, 0.0499, -0.0499, -0.05, None], "double", bands.sentiment_label,
     ["positive", "neutral", "neutral", "negative", None]),
    ([0.66, 0.65, 0.41, 0.4], "double", lambda c: bands.churn_level(F.col(c)),
     ["red", "yellow", "yellow", "green"]),
])
def test_cut_points(spark, values, kind, column, expected):
    assert _apply(spark, values, kind, column) == expected


def test_engagement_does_not_overflow(spark):
    df = spark.createDataFrame([(2147483647, 1), (None, 1)], "likes int, shares int")
    assert tuples(df.select(bands.engagement_score())) == [2147483651, None]


@pytest.mark.parametrize("text, masked", [
    ("10.20.30.40", "10.20.30.x"), ("10.20.30.x", "10.20.30.x"), ("no address", "no address"),
    (None, None),
])
def test_mask_ip(spark, text, masked):
    assert _apply(spark, [text], "string", lambda c: privacy.mask_ip(F.col(c))) == [masked]


@pytest.mark.parametrize("text, masked", [
    ("write to a.b+c@mail.example.com, now", "write to <email>, now"),
    ("from 10.0.0.1 and\n192.168.100.200.", "from <ip> and\n<ip>."),
    ("call +1 (743) 555-3824 or +49-30-1234-5678", "call <phone> or <phone>"),
    ("order 4316522678525456 costs 12.50", "order 4316522678525456 costs 12.50"),
    ("x" * 50_000 + " me@example.org", "x" * 50_000 + " <email>"),
])
def test_mask_text_covers_the_whole_text(spark, text, masked):
    assert _apply(spark, [text], "string", lambda c: privacy.mask_text(F.col(c))) == [masked]


def test_pseudonym_is_stable_and_salted(spark):
    same = _apply(spark, ["u", "u", None], "string",
                  lambda c: privacy.pseudonym(F.col(c), "a"))
    other = _apply(spark, ["u"], "string", lambda c: privacy.pseudonym(F.col(c), "b"))
    assert same[0] == same[1] != other[0] and same[2] is None and len(same[0]) == 64


def test_sums_ignore_what_is_no_amount(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (float("nan"),), (float("inf"),), (None,)],
                               "x double")
    row = df.agg(money_sum("x").alias("m"), score_mean("x", 4).alias("a")).first()
    assert str(row["m"]) == "0.30" and row["a"] == 0.15


def test_ratio_by_zero_is_null(spark):
    assert _apply(spark, [0, 3], "int", lambda c: ratio(F.lit(2), F.col(c), 2)) == [None, 0.67]


def test_text_forms(spark):
    df = spark.sql("select timestamp'2024-01-02 03:04:05' a,"
                   " timestamp'2024-01-02 03:04:05.000600' b, 'at_risk' l")
    assert tuples(df.select(iso_text("a"), iso_text("b"), title_text("l"))) == [
        ("2024-01-02T03:04:05", "2024-01-02T03:04:05.000600", "At Risk")]
