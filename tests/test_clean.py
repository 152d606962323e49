import random

from pyspark.sql import functions as F

from tests.rows import DAY, at, click, item, order, post, raw, review, tuples
from tierlake.operators.clean import clean_topic
from tierlake.operators.dedup import dedup_topic, latest_by_key
from tierlake.operators.quality import order_amount_check
from tierlake.session import tree_bytes
from tierlake.sinks.parquet import write_layer


def test_later_copy_wins_and_ties_go_to_the_larger_offset(spark):
    df = raw(spark, "clickstream",
             click("a", ingested_at=at(1), offset=1), click("a", ingested_at=at(2), offset=0),
             click("b", offset=1), click("b", offset=2), click("b", "v", "scroll", offset=0))
    assert tuples(dedup_topic(df, "clickstream"), "session_id", "event_type", "offset") == [
        ("a", "view", 0), ("b", "scroll", 0), ("b", "view", 2)]


def test_purchases_dedup_by_message_time_before_exploding(spark):
    df = raw(spark, "purchases",
             order("o", kafka_ts=at(1), items=[item("new"), item("new")]),
             order("o", kafka_ts=at(0), ingested_at=at(9), items=[item("old")]))
    assert tuples(clean_topic(df, "purchases"), "item_category") == ["new", "new"]


def test_rows_without_required_fields_go(spark):
    assert clean_topic(raw(spark, "clickstream", click(None), click(event=None)),
                       "clickstream").count() == 0
    assert clean_topic(raw(spark, "purchases", order(None), order(user=None)),
                       "purchases").count() == 0
    assert clean_topic(raw(spark, "product_reviews", review(None), review(user=None)),
                       "product_reviews").count() == 0
    social = clean_topic(raw(spark, "social_buzz", post(None), post("p", user=None)),
                         "social_buzz")
    assert tuples(social, "post_id", "has_user") == [("p", False)]


def test_dedup_is_idempotent_and_ignores_row_order(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(9), rng.randrange(3), i) for i in range(300)]
    key, order_by = ["k"], ["t", "i"]
    once = latest_by_key(spark.createDataFrame(rows, "k int, t int, i int"), key, order_by)
    rng.shuffle(rows)
    shuffled = latest_by_key(spark.createDataFrame(rows, "k int, t int, i int"), key, order_by)
    assert tuples(once) == tuples(shuffled) == tuples(latest_by_key(once, key, order_by))
    best = {}
    for k, t, i in rows:
        best[k] = max(best.get(k, (-1, -1)), (t, i))
    assert tuples(once) == sorted(((k, *v) for k, v in best.items()), key=str)


def test_orders_without_items_vanish(spark):
    df = raw(spark, "purchases", order("a", items=[]), {**order("b"), "items": None},
             order("c", items=[item("x", 6.0, 2, "s"), None]))
    assert tuples(clean_topic(df, "purchases"), "order_id", "item_sku", "item_qty",
                  "item_unit_price", "item_subtotal") == [
        ("c", "s", 2, 3.0, 6.0), ("c", None, None, None, None)]


def test_click_flags(spark):
    df = raw(spark, "clickstream", click("a", dwell_ms=119), click("b", dwell_ms=120),
             click("c", event="search", dwell_ms=None), click("d", event="add_to_cart"))
    assert tuples(clean_topic(df, "clickstream"), "session_id", "is_bot", "is_search",
                  "is_checkout", "hour_of_day", "day_of_week", "is_weekend") == [
        ("a", True, False, False, 10, 7, True), ("b", False, False, False, 10, 7, True),
        ("c", None, True, False, 10, 7, True), ("d", False, False, True, 10, 7, True)]


def test_viral_over_200(spark):
    df = raw(spark, "social_buzz", post("a", likes=200), post("b", likes=201),
             post("c", likes=1, shares=50), post("d", likes=None))
    assert tuples(clean_topic(df, "social_buzz"), "post_id", "engagement_score", "is_viral") == [
        ("a", 200, False), ("b", 201, True), ("c", 201, True), ("d", None, None)]


def test_ingestion_date_follows_ingestion(spark):
    df = raw(spark, "product_reviews", review(ingested_at=at(24 * 60)))
    assert tuples(clean_topic(df, "product_reviews"), "ingestion_date") == [at(24 * 60).date()]
    assert DAY.date() != at(24 * 60).date()


def test_order_amounts(spark):
    df = raw(spark, "purchases",
             order("good", "u", 9.5, [item("c", 6.0, 2), item("c", 4.0)], total_amount=10.0,
                   discount_pct=5.0),
             order("bad", "u", 8.0, [("k", "t", "c", 2, 3.0, 5.0)], total_amount=6.0),
             order("none", "u", 0.0, [], total_amount=0.0))
    assert tuples(order_amount_check(df), "order_id", "n_items", "bad_items", "computed_total",
                  "computed_final", "total_ok", "final_ok") == [
        ("bad", 1, 1, 5.0, 5.0, False, False), ("good", 2, 0, 10.0, 9.5, True, True),
        ("none", 0, 0, 0.0, 0.0, True, True)]


def test_texts_stay_with_their_copies(spark):
    rows = [review("r1", review_text="old"), review("r1", review_text="same", ingested_at=at(1)),
            review("r2", review_text="same"), review("r3", review_text=None),
            review("r4", review_text="", kafka_ts=at(1)), review("r4", review_text="late")]
    df = raw(spark, "product_reviews", *rows)
    latest = dedup_topic(df, "product_reviews")
    assert latest.schema == df.schema
    assert tuples(latest, "review_id", "review_text") == [
        ("r1", "same"), ("r2", "same"), ("r3", None), ("r4", "")]


def test_a_text_of_many_messages_is_stored_about_once(spark, folder):
    text = "".join(chr(33 + i * i * 31 % 89 + i % 5) + str(i * 7919 % 10007) for i in range(4000))
    df = raw(spark, "product_reviews", *(review(f"r{i}", review_text=text) for i in range(300)))
    write_layer(clean_topic(df.repartition(3), "product_reviews"), folder, gather=True)
    assert spark.read.parquet(folder).filter(F.col("review_text") == text).count() == 300
    assert tree_bytes(spark, folder) < 10 * len(text)
