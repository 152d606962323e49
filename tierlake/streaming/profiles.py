"""Profiles kept up to date with the clean logs."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import ExitStack
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tierlake.operators.profiles import READS, user_profiles
from tierlake.schemas import PROFILE
from tierlake.session import stored_for_now
from tierlake.sinks.keyed import KeyedTable, by_bucket
from tierlake.streaming.clean_log import CleanLog
from tierlake.streaming.run import EVERY_60_S, Trigger, start_batches, writer_of


def profile_table(spark: SparkSession, root: str, buckets: int = 64) -> KeyedTable:
    """Stored profiles, in parts by hash of the user id."""
    return KeyedTable(spark, root, PROFILE, ["user_id"], by_bucket("user_id", buckets))


def stream_profiles(logs: dict[str, CleanLog], segments: Callable[[], DataFrame], table: KeyedTable,
                    checkpoint: str, trigger: Trigger = EVERY_60_S,
                    as_of: datetime | None = None,
                    max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Recompute the profiles of the users a micro-batch mentions and replace them.

    ``segments`` scans the segment snapshot; it is called for each batch, so that the stream goes
    on with the newest snapshot after the metrics job has run.
    A user whose only message moved to another user loses its profile in the same step.
    """
    streams = [log.stream(max_files_per_trigger).select("user_id") for log in logs.values()]
    writer = writer_of(table.spark, checkpoint)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        with ExitStack() as stack:
            def store(df: DataFrame, label: str) -> DataFrame:
                return stack.enter_context(stored_for_now(df, label, table.spark))

            users = store(batch.filter(F.col("user_id").isNotNull()).distinct(), "users")
            if users.isEmpty():
                return
            # Each clean table is read more than once by the profile plan.
            tables = {f: store(log.clean(users=users).select(*READS[f]), f) for f, log in logs.items()}
            rows = user_profiles(
                tables["purchases"], tables["product_reviews"], tables["clickstream"],
                tables["social_buzz"], segments().join(users, "user_id", "left_semi"), as_of)
            table.upsert(rows, replaces=users, batch=(writer(), batch_id))

    return start_batches(reduce(DataFrame.unionByName, streams), refresh, checkpoint, trigger)
