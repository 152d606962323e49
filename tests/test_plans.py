"""What the physical plans must look like."""

from __future__ import annotations

import re
from datetime import date

import pytest

from checks import adapters
from tierlake.operators import metrics, profiles, segments
from tierlake.operators.clean import clean_topic
from tierlake.operators.dedup import dedup_topic
from tierlake.operators.ranking import percent_rank_desc
from tierlake.operators.sentiment import score_sentiment
from tierlake.plans import serving
from tierlake.schemas import TOPICS
from tierlake.sinks.parquet import write_layer
from tierlake.sources.messages import parse_topic
from tierlake.sources.tables import scan_table

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def clean(spark, tmp_path_factory):
    """Clean tables at rest."""
    root = tmp_path_factory.mktemp("clean")
    out = {}
    for folder, build in adapters.RAW.items():
        path = str(root / folder)
        clean_topic(build(spark, SF), folder).write.parquet(path)
        out[folder] = spark.read.parquet(path)
    return out


@pytest.fixture(scope="module")
def raw_clicks(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("raw") / "clicks")
    write_layer(adapters.raw_clickstream(spark, SF), path)
    return path


def test_no_python_in_any_plan(spark, clean):
    messages = adapters.messages(adapters.raw_clickstream(spark, SF), "clickstream")
    frames = [
        parse_topic(messages, TOPICS["clickstream"].message),
        metrics.hourly_sales(clean["purchases"]),
        metrics.hourly_site_traffic(clean["clickstream"]),
        metrics.hourly_sentiment(clean["product_reviews"], clean["social_buzz"]),
        profiles.profile_social(clean["social_buzz"]),
        score_sentiment(adapters.table(spark, SF, "documents"), "doc_id", "text"),
    ]
    for df in frames:
        assert not re.search("Python|ArrowEval|MapInPandas", _plan(df))


def test_dedup_limits_rows_before_the_shuffle(spark, raw_clicks):
    plan = _plan(dedup_topic(scan_table(spark, raw_clicks), "clickstream"))
    below_shuffle = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below_shuffle
    assert "IsNotNull(session_id), IsNotNull(event_type)" in plan


def test_scans_prune_dates_and_columns(spark, raw_clicks):
    df = scan_table(spark, raw_clicks, dates=(date(2024, 1, 2), date(2024, 1, 3)))
    plan = _plan(df.select("session_id"))
    assert re.search(r"PartitionFilters: \[isnotnull\(ingestion_date", plan)
    assert "ReadSchema: struct<session_id:string>" in plan


def test_metric_filters_reach_the_scan(clean):
    plan = _plan(metrics.hourly_sales(clean["purchases"]))
    assert "EqualTo(payment_status,success)" in plan
    assert "item_title" not in plan
    assert "EqualTo(user_id,u)" in _plan(clean["purchases"].filter("user_id = 'u'"))


def test_sentiment_aggregates_both_sources_in_one_shuffle(clean):
    plan = _plan(metrics.hourly_sentiment(clean["product_reviews"], clean["social_buzz"]))
    assert plan.count("Exchange") == 1


def test_distinct_counts_spread_a_busy_hour(clean):
    """The first shuffle is on the group and the counted value, not on the group alone."""
    plan = _plan(metrics.hourly_sales(clean["purchases"]))
    shuffles = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    assert "order_id" in shuffles[-1] and "order_id" not in shuffles[0]


def test_profile_sections_meet_without_another_shuffle(clean, spark):
    snapshot = segments.user_segments(clean["purchases"], clean["product_reviews"])
    plan = _plan(profiles.user_profiles(clean["purchases"], clean["product_reviews"],
                                        clean["clickstream"], clean["social_buzz"], snapshot))
    top = plan[:plan.index("Union")]
    assert "Exchange" not in top and "FullOuter" not in plan


def test_ranking_has_one_bounded_single_task_window(spark):
    """Only the running sum over groups of 2^36 values runs in one task."""
    plan = _plan(percent_rank_desc(spark.range(1000).withColumnRenamed("id", "v"), "v", "r"))
    single = re.findall(r"Window \[sum\((\w+)#\d+L?\) windowspecdefinition\((_hi|v|_mid)", plan)
    assert all(name == "_hi_n" for name, order in single if order == "_hi" and name != "_mid_n")
    assert "percent_rank" not in plan


def test_sentiment_words_join_by_broadcast_and_shuffle_one_row_per_text(spark):
    plan = _plan(score_sentiment(adapters.table(spark, SF, "documents"), "doc_id", "text"))
    assert "BroadcastHashJoin" in plan
    assert re.search(r"Exchange hashpartitioning\(doc_id.*\n\s*\+- HashAggregate", plan)


def test_top_n_does_not_sort_everything(spark, clean):
    df = serving.churn_risk_users(segments.user_segments(clean["purchases"],
                                                         clean["product_reviews"]))
    assert "TakeOrderedAndProject" in _plan(df)


def test_profile_sections_scan_their_table_once(clean):
    assert _plan(profiles.profile_browsing(clean["clickstream"])).count("FileScan") == 1
    assert _plan(profiles.profile_purchases(clean["purchases"])).count("FileScan") == 1
    by_order = _plan(profiles.profile_purchases(clean["purchases"], segments.ORDER))
    assert by_order.count("FileScan") == 1 and "item_" not in by_order


def test_dedup_moves_each_text_once(spark, tmp_path):
    """Texts meet as different ones, before and apart from the rows; unread ones not at all."""
    path = str(tmp_path / "reviews")
    write_layer(adapters.raw_product_reviews(spark, SF, with_text=True), path)
    latest = dedup_topic(scan_table(spark, path), "product_reviews")
    plan = _plan(latest)
    assert re.search(r"HashAggregate\(keys=\[_text_digest#\d+, review_text#\d+\]", plan)
    assert "Join" not in _plan(latest.drop("review_text"))
    assert "review_text" not in _plan(latest.drop("review_text"))


def test_line_items_move_once_before_they_are_collected(spark):
    plan = _plan(adapters.order_items(spark, SF))
    below = plan[plan.index("Exchange hashpartitioning(l_orderkey"):]
    assert "ObjectHashAggregate" in plan and "ObjectHashAggregate" not in below
    assert "SKU-" not in below
