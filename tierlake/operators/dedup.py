"""Keep the latest copy of each message."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tierlake.schemas import TOPICS

DIGEST = "_text_digest"


def latest_by_key(df: DataFrame, key: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """One row per key: the one with the largest ``latest_by`` columns, compared in order.

    Spark limits each task to its best row per key before the shuffle (WindowGroupLimit), so a
    key that holds a large share of all rows sends one row per task, not all of them.
    """
    order = Window.partitionBy(*key).orderBy(*(F.col(c).desc() for c in latest_by))
    return (df.withColumn("_rank", F.row_number().over(order))
            .filter(F.col("_rank") == 1).drop("_rank"))


def digest(text: str) -> Column:
    """Of a text, in 32 bytes; null for none."""
    return F.unhex(F.sha2(text, 256))


def texts_apart(rows: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the digest of their text in its place, and each different text once.

    Equal texts are made one in each task before they are shuffled, so copies of a message, and
    texts that many messages share, cost one text a task.
    """
    rows = rows.withColumn(DIGEST, digest(text))
    return rows.drop(text), different_texts(rows, text)


def different_texts(rows: DataFrame, text: str) -> DataFrame:
    """``DIGEST`` and text of rows that have both, each digest once."""
    different = rows.select(DIGEST, text).filter(
        F.col(DIGEST).isNotNull() & F.col(text).isNotNull()).distinct()
    # One row a digest, which lets Spark leave the join out where no text is read. Without a shuffle
    # in between Spark would see one aggregate do for both, and sort all texts for it.
    return different.repartition(DIGEST).groupBy(DIGEST).agg(F.first(text).alias(text))


def with_texts(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts back in rows that hold digests, as the last column. A merge join brings the rows
    out in the order of their texts: what shuffles or stores them next compresses equal ones."""
    return rows.join(texts.hint("merge"), DIGEST, "left").drop(DIGEST)


def around_text(rows: DataFrame, text: str | None,
                step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply a step that keeps the columns but reads no text, without moving the texts."""
    if text not in rows.columns:
        return step(rows)
    narrow, texts = texts_apart(rows, text)
    return with_texts(step(narrow), texts).select(*rows.columns)


def dedup_topic(raw: DataFrame, folder: str) -> DataFrame:
    """Drop raw rows of a topic that lack a required field, and keep the latest copy by key."""
    topic = TOPICS[folder]
    return around_text(complete_rows(raw, folder), topic.text,
                       lambda rows: latest_by_key(rows, topic.key, topic.latest_by))


def complete_rows(raw: DataFrame, folder: str) -> DataFrame:
    """Rows of a topic that have every required field."""
    # isNotNull per column, unlike dropna, is pushed into the Parquet scan.
    return raw.filter(reduce(and_, (F.col(c).isNotNull() for c in TOPICS[folder].required)))
