from decimal import Decimal

from tests.rows import DAY, at, click, item, order, post, raw, review, tuples
from tierlake.operators import metrics
from tierlake.operators.clean import clean_topic
from tierlake.operators.quality import (conform, contract_violations, fill_defaults,
                                        pk_violations)
from tierlake.plans import serving
from tierlake.schemas import METRICS


def _clean(spark, folder, *rows):
    return clean_topic(raw(spark, folder, *rows), folder)


def test_sales_count_lines_and_distinct_orders(spark):
    df = _clean(spark, "purchases",
                order("a", items=[item("x", 0.1), item("x", 0.2)], is_return=True),
                order("b", items=[item("x", 1.0), item("y", 2.0)]),
                order("c", payment_status="failed"), order("d", payment_status=None),
                order("e", event_ts=None), order("f", event_ts=at(60), items=[item("x", 5.0)]))
    assert tuples(metrics.hourly_sales(df)) == [
        (DAY, at(60), "x", Decimal("1.30"), 2, 2), (DAY, at(60), "y", Decimal("2.00"), 1, 0),
        (at(60), at(120), "x", Decimal("5.00"), 1, 0)]


def test_category_revenue_adds_up_to_the_total(spark):
    sales = metrics.hourly_sales(_clean(
        spark, "purchases", *(order(f"o{i}", items=[item(f"c{i % 3}", i / 7)])
                              for i in range(50))))
    by_category = sum(r["revenue"] for r in serving.revenue_by_category(sales).collect())
    assert by_category == serving.kpi_sales(sales).first()["revenue"]


def test_search_trends_fold_case_and_need_two(spark):
    df = _clean(spark, "clickstream",
                click("a", "u", "search", keyword="Shoes"),
                click("b", "u", "search", keyword="shoes"),
                click("c", "u", "search", keyword="once"),
                click("d", "u", "search", keyword=None), click("e", "u", "view", keyword="x"))
    assert tuples(metrics.hourly_search_trends(df), "keyword", "search_count",
                  "unique_visitors") == [("shoes", 2, 1)]


def test_traffic_leaves_out_bots_and_unknown(spark):
    df = _clean(spark, "clickstream", click("a", "u", dwell_ms=120), click("a", "u", "scroll"),
                click("b", None, dwell_ms=200), click("c", dwell_ms=119),
                click("d", dwell_ms=None))
    assert tuples(metrics.hourly_site_traffic(df)) == [(DAY, at(60), 2, 2, 1, 1, 273)]


def test_sentiment_counts(spark):
    reviews = _clean(spark, "product_reviews",
                     *(review(f"r{i}", score=s) for i, s in enumerate(
                         [0.05, 0.0499, -0.0499, -0.05, None])))
    social = _clean(spark, "social_buzz", post("p", score=None))
    rows = tuples(metrics.hourly_sentiment(reviews, social))
    assert rows == [(DAY, at(60), "reviews", Decimal("0.0000"), 1, 2, 1, 5),
                    (DAY, at(60), "social_buzz", None, 0, 0, 0, 1)]
    assert all(r[4] + r[5] + r[6] <= r[7] for r in rows)


def test_conform_and_violations(spark):
    table = METRICS["hourly_sentiment"]
    df = spark.createDataFrame(
        [(DAY, at(60), "reviews", "99999.5", 1, 0, 0, 1), (None, at(60), "r", "0.5", 1, 0, 0, 1)],
        "window_start timestamp, window_end timestamp, data_source string,"
        " mean_sentiment string, positive_cnt int, neutral_cnt int, negative_cnt int,"
        " total_cnt int")
    rows = conform(df, table)
    assert [(f.name, f.dataType) for f in rows.schema] == [
        (f.name, f.dataType) for f in table.stored]
    found = {r["rule"]: r["violations"] for r in contract_violations(rows, table).collect()}
    assert found["mean_sentiment not null"] == 1 and found["window_start not null"] == 1
    assert found["total_cnt not null"] == 0
    filled = contract_violations(fill_defaults(rows, table), table).collect()
    assert {r["rule"]: r["violations"] for r in filled}["mean_sentiment not null"] == 0


def test_pk_violations(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "k int, v string")
    assert tuples(pk_violations(df, ["k", "v"])) == [(1, "a", 2)]


def test_kpis_of_nothing(spark):
    empty = metrics.hourly_sales(_clean(spark, "purchases"))
    assert tuples(serving.kpi_sales(empty)) == [(None, None, None, 0.0)]


def test_top_keywords_respects_minimum_and_limit(spark):
    trends = spark.createDataFrame([("a", 5, 2), ("a", 1, 1), ("b", 5, 5), ("c", 9, 3)],
                                   "keyword string, search_count long, unique_visitors long")
    assert [tuple(r) for r in serving.top_keywords(trends, 2, 2).collect()] == [
        ("c", 9, 3, 3.0), ("a", 5, 2, 2.5)]


def test_sketches_are_not_kept_for_each_counted_value(spark):
    from checks.queries import QUERIES
    plan = QUERIES["distinct_approx"](spark, "/root/testdata/sf0.001")._jdf.queryExecution(
        ).executedPlan().toString()
    sketches = [line for line in plan.splitlines() if "approx_count_distinct" in line]
    assert sketches and not any("Expand" in line or "gid" in line for line in sketches)
    assert all("keys=[platform" in line or "keys=[_groupingexpression" in line
               for line in sketches if "Aggregate(keys" in line)
