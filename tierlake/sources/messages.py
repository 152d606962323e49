"""Reading a topic and parsing its messages.

A topic is read from Kafka, or from files with Kafka's columns (an archived log, and what the
tests use). Both give ``value, topic, partition, offset, timestamp``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tierlake.schemas import MESSAGE_LOG, Topic
from tierlake.sources.tables import scan_or_none

_CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class KafkaLog:
    """Topics on a Kafka cluster. Needs the spark-sql-kafka package on the classpath."""

    bootstrap_servers: str
    options: dict[str, str] = field(default_factory=dict)

    def _options(self, topic: Topic) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.bootstrap_servers, "subscribe": topic.name,
                "startingOffsets": "earliest", **self.options}

    def batch(self, spark: SparkSession, topic: Topic) -> DataFrame:
        options = {"endingOffsets": "latest", **self._options(topic)}
        return spark.read.format("kafka").options(**options).load()

    def stream(self, spark: SparkSession, topic: Topic) -> DataFrame:
        # Spark's default stands: messages that have gone before they were read are an error.
        return spark.readStream.format("kafka").options(**self._options(topic)).load()


@dataclass(frozen=True)
class FileLog:
    """Topics archived as Parquet, one folder per topic below ``root``."""

    root: str
    options: dict[str, str] = field(default_factory=dict)

    def path(self, topic: Topic) -> str:
        return f"{self.root.rstrip('/')}/{topic.folder}"

    def batch(self, spark: SparkSession, topic: Topic) -> DataFrame:
        """The archived messages; none where the topic has no folder."""
        rows = scan_or_none(spark, self.path(topic), MESSAGE_LOG)
        return spark.createDataFrame([], MESSAGE_LOG) if rows is None else rows

    def stream(self, spark: SparkSession, topic: Topic) -> DataFrame:
        return (spark.readStream.schema(MESSAGE_LOG).options(**self.options)
                .parquet(self.path(topic)))


MessageLog = KafkaLog | FileLog


def read_topic_batch(spark: SparkSession, log: MessageLog, topic: Topic) -> DataFrame:
    """All messages a topic holds now."""
    return log.batch(spark, topic)


def read_topic_stream(spark: SparkSession, log: MessageLog, topic: Topic) -> DataFrame:
    """The messages of a topic from its beginning, and those still to come."""
    return log.stream(spark, topic)


def _decode(messages: DataFrame, schema: StructType) -> DataFrame:
    """Envelope, message text, the parsed message as struct ``data``, and what is wrong with it.

    ``reason`` is null for a message that parses in full; ``no_value`` has no body, ``malformed`` is
    no JSON or holds a field of the wrong type, ``bad_timestamp`` has a time that is not a time.
    """
    with_corrupt = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    stamp = F.col("data.timestamp")
    return messages.select(
        F.col("value").cast("string").alias("raw_json"),
        "topic", "partition", "offset", F.col("timestamp").alias("kafka_ts"),
    ).withColumn("data", F.from_json(
        "raw_json", with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )).withColumn(
        "reason", F.when(F.col("raw_json").isNull(), "no_value")
        .when(F.col(f"data.{_CORRUPT}").isNotNull(), "malformed")
        .when(stamp.isNotNull() & F.try_to_timestamp(stamp).isNull(), "bad_timestamp"))


def parse_topic(messages: DataFrame, schema: StructType, ingested_at: Column | None = None,
                reason_as: str | None = None) -> DataFrame:
    """Messages to raw rows.

    A field of the wrong type is null and the others are kept; text that is no JSON gives a row
    of nulls, which the cleaning filters drop. A malformed time is null, never an error.
    ``ingested_at`` defaults to the time of the batch; ``reason_as`` adds what is wrong with a
    message, from the same parse.
    """
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    body = [F.col(f"data.{n}").alias(n) for n in schema.names if n != "timestamp"]
    reason = [] if reason_as is None else [F.col("reason").alias(reason_as)]
    return (
        _decode(messages, schema)
        .select("topic", "partition", "offset", "kafka_ts", *body,
                F.try_to_timestamp(F.col("data.timestamp")).alias("event_ts"),
                stamp.alias("ingested_at"), *reason)
        .withColumn("ingestion_date", F.to_date("ingested_at"))
    )


def quarantine(messages: DataFrame, schema: StructType) -> DataFrame:
    """Messages that do not parse in full, with the reason."""
    return _decode(messages, schema).filter(F.col("reason").isNotNull()).select(
        "topic", "partition", "offset", "kafka_ts", "raw_json", "reason")
