from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import _write_in_parts
from tests.rows import DAY, at, click, item, order, post, raw, review, tuples
from tierlake.operators import metrics, profiles, segments
from tierlake.operators.clean import clean_topic
from tierlake.schemas import TOPICS
from tierlake.sources.tables import table_stream
from tierlake.streaming.clean_log import CleanLog, stream_clean, stream_clean_first
from tierlake.streaming.metrics import metric_table, stream_hourly, stream_sentiment
from tierlake.streaming.profiles import profile_table, stream_profiles
from tierlake.streaming.run import DRAIN, start_batches, wait_for

AS_OF = datetime(2024, 6, 1)


def _hours(spark, *hours):
    return spark.createDataFrame([(h,) for h in hours], "event_hour timestamp")


# Versions of one order: (arrives in batch, message minute, event minute, user).
MOVES = [
    [(0, 1, 0, "u"), (1, 2, 70, "u")],                      # moves to a later hour
    [(0, 2, 0, "u"), (1, 1, 70, "u")],                      # an older copy arrives late
    [(0, 1, 0, "u"), (1, 2, 70, "u"), (2, 3, 5, "u")],      # moves away and back
    [(0, 3, 0, "u"), (0, 1, 70, "u"), (1, 2, 130, "v")],    # two older copies
    [(0, 1, 0, "u"), (1, 2, 0, "v")],                       # same hour, other user
    [(0, 1, 0, "u"), (1, 1, 0, "u")],                       # the same message again
    [(0, 1, None, "u"), (1, 2, 0, "u"), (2, 3, None, "u")],  # no time, a time, none again
]


@pytest.mark.parametrize("versions", MOVES)
def test_partial_reads_of_the_clean_log_are_exact(spark, folder, versions):
    def rows(batch=None):
        return [order(kafka_ts=at(sent), user=user, offset=sent,
                      event_ts=None if event is None else at(event))
                for b, sent, event, user in versions if batch is None or b == batch]

    log = CleanLog(spark, folder, "purchases")
    for batch in range(3):
        if rows(batch):
            log.land(raw(spark, "purchases", *rows(batch)), batch)
    expected = clean_topic(raw(spark, "purchases", *rows()), "purchases")
    columns = ("order_id", "user_id", "event_ts", "kafka_ts")
    assert tuples(log.clean(), *columns) == tuples(expected, *columns)
    for hour in (DAY, at(60), at(120)):
        inside = expected.filter(F.date_trunc("hour", "event_ts") == F.lit(hour))
        assert tuples(log.clean(hours=_hours(spark, hour)), *columns) == tuples(inside, *columns)
    for user in "uv":
        users = spark.createDataFrame([(user,)], "user_id string")
        mine = expected.filter(F.col("user_id") == user)
        assert tuples(log.clean(users=users), *columns) == tuples(mine, *columns)


def test_landing_a_batch_again_changes_nothing(spark, folder):
    log = CleanLog(spark, folder, "clickstream")
    log.land(raw(spark, "clickstream", click("a", ingested_at=at(1))), 0)
    batch = raw(spark, "clickstream", click("a", ingested_at=at(2), event_ts=at(90)), click("b"))
    log.land(batch, 1)
    once = tuples(log.latest())
    stored = spark.read.parquet(folder).count()
    log.land(batch, 1)
    assert tuples(log.latest()) == once and spark.read.parquet(folder).count() == stored


def _batches(spark, folder, path, *batches):
    """Append each batch as one file."""
    for rows in batches:
        raw(spark, folder, *rows).coalesce(1).write.mode("append").parquet(path)


def _drain_clean(spark, source, log, checkpoint):
    stream = table_stream(spark, source, TOPICS[log.folder].raw, 1)
    wait_for([stream_clean(stream, log, checkpoint, DRAIN)])


@pytest.fixture
def purchases(spark, tmp_path):
    """A raw source, its log and the hourly sales kept by streams; call to drain both."""
    source, log = str(tmp_path / "raw"), CleanLog(spark, str(tmp_path / "log"), "purchases")
    table = metric_table(spark, str(tmp_path / "sales"), "hourly_sales")

    def drain():
        _drain_clean(spark, source, log, str(tmp_path / "c1"))
        wait_for([stream_hourly({"purchases": log}, "hourly_sales", table,
                                str(tmp_path / "c2"), DRAIN, 1)])
        return tuples(table.read())

    return source, drain


def test_sales_follow_moved_and_late_orders_across_restarts(spark, purchases):
    source, drain = purchases
    first = [order("a", items=[item("x")]), order("b", items=[item("y")])]
    second = [order("a", items=[item("x")], kafka_ts=at(1), event_ts=at(70), offset=9),
              order("late", event_ts=at(-500))]
    third = [order("b", items=[item("y")], kafka_ts=at(1), payment_status="failed", offset=10)]
    _batches(spark, "purchases", source, first)
    drain()
    # The drained streams have ended; the next ones go on from their checkpoints.
    _batches(spark, "purchases", source, second, third)
    got = drain()
    everything = raw(spark, "purchases", *first, *second, *third)
    assert got == tuples(metrics.hourly_sales(clean_topic(everything, "purchases")))
    assert {r[0] for r in got} == {at(60), at(-540)}
    assert drain() == got


def test_a_fresh_checkpoint_loses_nothing(spark, tmp_path):
    """Batch numbers start again with a checkpoint; the batches are others all the same."""
    log = CleanLog(spark, str(tmp_path / "log"), "purchases")
    table = metric_table(spark, str(tmp_path / "sales"), "hourly_sales")
    parts = [[order("a", items=[item("x")]), order("b", items=[item("y")])],
             [order("c", items=[item("z")]), order("a", items=[item("x")], kafka_ts=at(1),
                                                   event_ts=at(70), offset=9)]]
    for n, rows in enumerate(parts):
        _batches(spark, "purchases", str(tmp_path / f"raw{n}"), rows)
        for _ in range(2):  # the second time goes on from the checkpoint and finds nothing new
            _drain_clean(spark, str(tmp_path / f"raw{n}"), log, str(tmp_path / f"clean{n}"))
            wait_for([stream_hourly({"purchases": log}, "hourly_sales", table,
                                    str(tmp_path / f"hourly{n}"), DRAIN, 1)])
    everything = clean_topic(raw(spark, "purchases", *parts[0], *parts[1]), "purchases")
    assert tuples(log.clean(), "order_id", "event_ts") == tuples(
        everything, "order_id", "event_ts")
    assert tuples(table.read()) == tuples(metrics.hourly_sales(everything))
    writers = {f.name for f in (tmp_path / "log").iterdir() if f.name.startswith("writer=")}
    assert len(writers) == 2 and len(table.published().batches) == 2


def test_a_batch_that_is_run_again_after_a_crash_changes_nothing(spark, tmp_path):
    from tierlake.streaming.run import writer_of

    source, checkpoint = str(tmp_path / "raw"), tmp_path / "c"
    log = CleanLog(spark, str(tmp_path / "log"), "clickstream")
    _batches(spark, "clickstream", source, [click("a")], [click("b", event_ts=at(60))])
    _drain_clean(spark, source, log, str(checkpoint))
    once, writer = tuples(log.latest()), writer_of(spark, str(checkpoint))()
    files = sorted((tmp_path / "log").rglob("*.parquet"))
    # Without its commit Spark runs the last batch once more, under the same number.
    commits = sorted(checkpoint.glob("commits/*"), key=lambda f: f.name)
    for commit in [commits[-1], checkpoint / "commits" / f".{commits[-1].name}.crc"]:
        commit.unlink(missing_ok=True)
    _drain_clean(spark, source, log, str(checkpoint))
    assert tuples(log.latest()) == once
    assert sorted((tmp_path / "log").rglob("*.parquet")) == files
    assert writer_of(spark, str(checkpoint))() == writer


def test_incremental_sentiment_updates_and_drops_by_watermark(spark, tmp_path):
    source = str(tmp_path / "scores")
    schema = "event_ts timestamp, sentiment_score double"

    def add(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)

    table = metric_table(spark, str(tmp_path / "t"), "hourly_sentiment")

    def drain():
        scores = table_stream(spark, source, spark.createDataFrame([], schema).schema, 1)
        wait_for([stream_sentiment(metrics.scored_events(scores, "reviews"), table,
                                   str(tmp_path / "c"), "3 hours", DRAIN)])
        return tuples(table.read(), "window_start", "positive_cnt", "total_cnt")

    add((DAY, 0.5))
    assert drain() == [(DAY, 1, 1)]
    add((at(200), 0.5), (at(1), -0.5))
    assert drain() == [(DAY, 1, 2), (at(180), 1, 1)]
    add((at(30), 0.5))  # within three hours of the latest time seen: its hour is still open
    assert drain() == [(DAY, 2, 3), (at(180), 1, 1)]
    add((at(600), 0.5))
    drain()
    add((at(2), 0.5))  # the hour has been closed
    assert drain() == [(DAY, 2, 3), (at(180), 1, 1), (at(600), 1, 1)]


def test_profiles_follow_the_logs(spark, tmp_path):
    first = {"purchases": [order("o", "u"), order("o2", "w")],
             "product_reviews": [review("r", "u")],
             "clickstream": [click("s", "v")], "social_buzz": [post("p", "v")]}
    # Order o turns out to be of user x; u keeps the review, v gets another click.
    second = {"purchases": [order("o", "x", kafka_ts=at(1), offset=7)],
              "clickstream": [click("s2", "v", offset=8)]}
    logs = {f: CleanLog(spark, str(tmp_path / f), f) for f in TOPICS}
    table = profile_table(spark, str(tmp_path / "profiles"), 4)
    empty = segments.user_segments(clean_topic(raw(spark, "purchases"), "purchases"),
                                   clean_topic(raw(spark, "product_reviews"), "product_reviews"))

    def drain():
        wait_for([stream_profiles(logs, lambda: empty, table, str(tmp_path / "c"), DRAIN, AS_OF)])
        return tuples(profiles.flatten_profiles(table.read()))

    for batch, tables in enumerate((first, second)):
        for f, rows in tables.items():
            logs[f].land(raw(spark, f, *rows), batch)
        got = drain()
    clean = {f: clean_topic(raw(spark, f, *first[f], *second.get(f, [])), f) for f in TOPICS}
    expected = profiles.user_profiles(clean["purchases"], clean["product_reviews"],
                                      clean["clickstream"], clean["social_buzz"], empty, AS_OF)
    assert got == tuples(profiles.flatten_profiles(expected))
    assert {r[0] for r in got} == {"u", "v", "w", "x"}


def test_a_failing_stream_stops_the_others(spark, tmp_path):
    source = str(tmp_path / "raw")
    _batches(spark, "clickstream", source, [click()])

    def boom(rows, batch_id):
        raise RuntimeError("boom")

    def stream():
        return table_stream(spark, source, TOPICS["clickstream"].raw)

    bad = start_batches(stream(), boom, str(tmp_path / "c1"), DRAIN)
    good = start_batches(stream(), lambda rows, i: None, str(tmp_path / "c2"),
                         {"processingTime": "1 hour"})
    with pytest.raises(Exception, match="boom"):
        wait_for([bad, good])
    assert not good.isActive


def test_wait_for_sees_a_failure_of_any_stream(spark, tmp_path):
    def boom(rows, batch_id):
        raise RuntimeError("boom")

    source = str(tmp_path / "raw")
    _batches(spark, "clickstream", source, [click()])

    def stream():
        return table_stream(spark, source, TOPICS["clickstream"].raw)

    good = start_batches(stream(), lambda rows, i: None, str(tmp_path / "c1"),
                         {"processingTime": "1 hour"})
    bad = start_batches(stream(), boom, str(tmp_path / "c2"), DRAIN)
    with pytest.raises(Exception, match="boom"):
        wait_for([good, bad])
    assert not good.isActive


def test_masked_stream_stores_no_clear_text(spark, tmp_path):
    source, root = str(tmp_path / "raw"), str(tmp_path / "log")
    _batches(spark, "social_buzz", source, [post("a", content="ask me@example.org")])
    log = CleanLog(spark, root, "social_buzz")
    wait_for([stream_clean(table_stream(spark, source, TOPICS["social_buzz"].raw), log,
                           str(tmp_path / "c"), DRAIN, masked=True, salt="s")])
    stored = spark.read.parquet(root)
    assert tuples(stored, "content") == [("ask <email>")]
    assert all(len(u) == 64 for u in tuples(stored, "user_id"))


def test_landing_a_batch_again_leaves_its_files(spark, tmp_path):
    root = tmp_path / "log"
    log = CleanLog(spark, str(root), "clickstream")
    log.land(raw(spark, "clickstream", click()), 0)
    before = sorted(root.rglob("*.parquet"))
    log.land(raw(spark, "clickstream", click()), 0)
    assert sorted(root.rglob("*.parquet")) == before


def test_hours_prune_the_scan_of_the_log(spark, tmp_path):
    log = CleanLog(spark, str(tmp_path / "log"), "clickstream")
    log.land(raw(spark, "clickstream", *(click(f"s{i}", event_ts=at(1440 * i))
                                         for i in range(5))), 0)
    path = str(tmp_path / "hours")
    raw(spark, "clickstream", click(event_ts=at(1440))).selectExpr(
        "date_trunc('hour', event_ts) AS event_hour").write.parquet(path)
    found = log.latest(hours=spark.read.parquet(path))
    assert tuples(found, "session_id") == ["s1"]
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()


def test_first_copy_stream(spark, tmp_path):
    source, path = str(tmp_path / "raw"), str(tmp_path / "clean")
    _batches(spark, "social_buzz", source, [post("a", likes=1), post(None)],
             [post("a", likes=2, kafka_ts=at(1)), post("b", likes=300, kafka_ts=at(1))])
    stream = table_stream(spark, source, TOPICS["social_buzz"].raw, 1)
    wait_for([stream_clean_first(stream, "social_buzz", path, str(tmp_path / "c"),
                                 trigger=DRAIN)])
    assert tuples(spark.read.parquet(path), "post_id", "likes", "is_viral") == [
        ("a", 1, False), ("b", 300, True)]


def test_streams_leave_no_scratch_files(spark, tmp_path):
    from pathlib import Path

    from tierlake.session import shared_folder

    log = CleanLog(spark, str(tmp_path / "log"), "clickstream")
    table = metric_table(spark, str(tmp_path / "t"), "hourly_site_traffic")
    before = set(Path(shared_folder(spark)).iterdir())
    log.land(raw(spark, "clickstream", click()), 0)
    log.land(raw(spark, "clickstream"), 1)
    wait_for([stream_hourly({"clickstream": log}, "hourly_site_traffic", table,
                            str(tmp_path / "c"), DRAIN)])
    assert table.read().count() == 1
    assert set(Path(shared_folder(spark)).iterdir()) == before


def test_streams_start_before_there_is_data(spark, tmp_path):
    source, log = str(tmp_path / "raw"), CleanLog(spark, str(tmp_path / "log"), "clickstream")
    table = metric_table(spark, str(tmp_path / "t"), "hourly_site_traffic")

    def drain():
        _drain_clean(spark, source, log, str(tmp_path / "c1"))
        wait_for([stream_hourly({"clickstream": log}, "hourly_site_traffic", table,
                                str(tmp_path / "c2"), DRAIN)])
        return table.read().count()

    assert drain() == 0
    _batches(spark, "clickstream", source, [click("a"), click("b", event_ts=at(60))])
    assert drain() == 2


def test_sources_of_several_batches_have_several_files_a_batch(spark, folder):
    """A batch grows with the data, so one file may not hold all of it."""
    rows = spark.range(3000).withColumnRenamed("id", "offset").repartition(4)
    assert _write_in_parts(rows, folder) == 4
    stored = spark.read.parquet(folder)
    assert len(stored.inputFiles()) == 12
    assert stored.distinct().count() == stored.count() == 3000


def test_a_batch_stores_each_text_once(spark, tmp_path):
    """Whatever the hours and copies of its messages; readers get it in every row."""
    root = str(tmp_path / "log")
    log = CleanLog(spark, root, "product_reviews", "month")
    texts = ["same", "same", "other", None, "", "same"]
    rows = [review(f"r{i}", review_text=t, event_ts=at(50_000 * i)) for i, t in enumerate(texts)]
    log.land(raw(spark, "product_reviews", *rows), 0)
    newer = review("r2", review_text="same", ingested_at=at(1), event_ts=at(90), offset=9)
    log.land(raw(spark, "product_reviews", newer), 1)
    stored = spark.read.parquet(root)
    assert tuples(stored.filter("batch_id = 0 AND review_text IS NOT NULL"), "review_text") == [
        "", "other", "same"]
    assert tuples(stored.filter("batch_id = 1"), "is_marker", "review_text") == [
        (False, "same"), (True, None)]
    texts[2] = "same"
    assert tuples(log.clean(), "review_id", "review_text") == [
        (f"r{i}", t) for i, t in enumerate(texts)]
    hours = _hours(spark, *(at(50_000 * i).replace(minute=0) for i in (1, 5)))
    assert tuples(log.clean(hours=hours), "review_id", "review_text") == [
        ("r1", "same"), ("r5", "same")]


def test_logs_with_a_text_in_every_row_are_still_read(spark, tmp_path):
    rows = raw(spark, "product_reviews", review("r1", review_text="a"), review("r2"))
    (rows.selectExpr("*", "date_trunc('hour', event_ts) AS event_hour", "false AS is_marker",
                     "'w' AS writer", "0L AS batch_id", "date '2024-03-01' AS period")
     .write.partitionBy("writer", "batch_id", "period").parquet(str(tmp_path / "log")))
    log = CleanLog(spark, str(tmp_path / "log"), "product_reviews", "month")
    log.land(raw(spark, "product_reviews", review("r2", review_text="b", ingested_at=at(1))), 1)
    assert tuples(log.clean(), "review_id", "review_text") == [("r1", "a"), ("r2", "b")]
