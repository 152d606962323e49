import json

import pytest

from tests.rows import DAY, tuples
from tierlake.schemas import MESSAGE_LOG, TOPICS
from tierlake.sources.messages import FileLog, KafkaLog, parse_topic, quarantine
from tierlake.sources.tables import Jdbc, JdbcSplit, has_rows, scan_or_none

CLICKS = TOPICS["clickstream"]
GOOD = {"session_id": "s", "user_id": "u", "dwell_ms": 7, "timestamp": "2024-03-09T10:00:00Z"}


def _messages(spark, *values):
    rows = [(None if v is None else bytearray(v if isinstance(v, bytes) else v.encode()),
             "clickstream", 0, i, DAY) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, MESSAGE_LOG)


CASES = [
    (json.dumps(GOOD), ("s", 7, DAY), None),
    ("{bad", (None, None, None), "malformed"),
    (json.dumps({**GOOD, "dwell_ms": "zz"}), ("s", None, DAY), "malformed"),
    (json.dumps({**GOOD, "dwell_ms": 1.5}), ("s", None, DAY), "malformed"),
    (json.dumps({**GOOD, "timestamp": "nope"}), ("s", 7, None), "bad_timestamp"),
    (json.dumps({"session_id": "s"}), ("s", None, None), None),
    (json.dumps({**GOOD, "unknown": 1}), ("s", 7, DAY), None),
    (None, (None, None, None), "no_value"),
]


@pytest.mark.parametrize("value, fields, reason", CASES)
def test_damaged_messages(spark, value, fields, reason):
    messages = _messages(spark, value)
    parsed = parse_topic(messages, CLICKS.message)
    assert tuples(parsed, "session_id", "dwell_ms", "event_ts") == [fields]
    assert tuples(quarantine(messages, CLICKS.message), "reason") == ([reason] if reason else [])


def test_zone_offsets_become_utc(spark):
    value = json.dumps({**GOOD, "timestamp": "2024-03-09T15:30:00.000001+05:30"})
    parsed = parse_topic(_messages(spark, value), CLICKS.message)
    assert tuples(parsed, "event_ts") == [DAY.replace(microsecond=1)]


@pytest.mark.parametrize("folder", TOPICS)
def test_parsed_schema_is_the_raw_schema(spark, folder):
    topic = TOPICS[folder]
    parsed = parse_topic(_messages(spark, "{}"), topic.message)
    assert [(f.name, f.dataType) for f in parsed.schema] == [
        (f.name, f.dataType) for f in topic.raw]


def test_quarantine_leaves_the_declared_schema_alone(spark):
    before = list(CLICKS.message.names)
    quarantine(_messages(spark, "{}"), CLICKS.message)
    assert CLICKS.message.names == before


def test_kafka_options():
    log = KafkaLog("broker:9092", {"startingOffsets": "latest"})
    options = log._options(TOPICS["social_buzz"])
    assert options == {"kafka.bootstrap.servers": "broker:9092", "subscribe": "social-buzz",
                       "startingOffsets": "latest"}


def test_missing_and_empty_sources(spark, folder):
    assert scan_or_none(spark, folder, CLICKS.raw) is None
    assert scan_or_none(spark, folder) is None
    _messages(spark).write.parquet(f"{folder}/clickstream")
    log = FileLog(folder).batch(spark, CLICKS)
    assert not has_rows(log)


def test_relational_options():
    database = Jdbc("jdbc:x", "a.Driver", {"user": "me"})
    split = JdbcSplit("id", "0", "100", 4)
    assert database.options("t") | split.options() == {
        "url": "jdbc:x", "driver": "a.Driver", "dbtable": "t", "user": "me",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
