"""Starting streams, waiting for them and stopping them."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

Trigger = dict[str, str | bool]

DRAIN: Trigger = {"availableNow": True}
EVERY_30_S: Trigger = {"processingTime": "30 seconds"}
EVERY_60_S: Trigger = {"processingTime": "60 seconds"}


def writer_of(spark: SparkSession, checkpoint: str) -> Callable[[], str]:
    """Asks for the identity of the stream that a checkpoint belongs to.

    Batch numbers start at 0 in every checkpoint, so a batch is known by its stream and number.
    Spark keeps the stream's id in the checkpoint, before the first batch; a restart has the same.
    """
    @cache
    def writer() -> str:
        text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").collect()
        return json.loads("".join(row[0] for row in text))["id"]

    return writer


def start_batches(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str,
                  trigger: Trigger = EVERY_60_S, mode: str = "append") -> StreamingQuery:
    """Start a stream that hands every micro-batch to ``apply(rows, batch_id)``.

    ``apply`` should store the rows once and go on from there: each action on them runs the
    stream's own plan again, state included.
    """
    return (stream.writeStream.foreachBatch(apply).outputMode(mode)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def wait_for(queries: Sequence[StreamingQuery], look_every: float = 1.0) -> None:
    """Wait until all streams end; if any of them fails or the user interrupts, stop the others.

    Streams are looked at in turn, so a failure is seen whichever of them it hits.
    """
    try:
        running = list(queries)
        while running:
            # Raises if this one has failed; true if it has ended well.
            ended = running[0].awaitTermination(look_every)
            failed = next((q for q in running if q.exception() is not None), None)
            if failed is not None:
                failed.awaitTermination()
            running = running[1:] if ended else [*running[1:], running[0]]
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
