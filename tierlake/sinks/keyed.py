"""Keyed Parquet tables: replace rows by key without touching files that are being read.

A table is split into parts (a date, or a bucket of the key). An upsert rewrites only the parts
it touches, into a new version folder, and then publishes a small table that says which version
holds each part. Readers follow the latest published one, so they see all of an upsert or none
of it, and a run that dies half way leaves the table as it was.

    root/data/table_version=<n>/table_part=<part>/...   rows
    root/published/table_version=<n>/...                part, data_version; writer, batch_id

The rule that makes parts is published too: a table cannot be opened with another one, which
would leave the same key in two parts. Versions that nobody has followed for ``retention`` seconds
are deleted by the upserts after.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tierlake.session import COMPRESSION, child_times, is_written, remove_tree, stored_for_now

# Named so that no column of a table is called the same.
_PART, _VERSION = "table_part", "table_version"
_PUBLISHED = "part string, data_version long, writer string, batch_id long, rule string"
RETENTION = 86_400.0


def by_date(ts: str) -> Column:
    """Parts by calendar date of a time."""
    return F.date_format(ts, "yyyy-MM-dd")


def by_month(ts: str) -> Column:
    """Parts by calendar month, for tables with little data per day."""
    return F.date_format(ts, "yyyy-MM")


def by_bucket(key: str, buckets: int) -> Column:
    """Parts by hash of a key; keys are unique in the table, so buckets are even."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string")


@dataclass(frozen=True)
class Published:
    """Which version holds each part, and the last batch each writer has applied."""

    version: int = 0
    parts: dict[str, int] = field(default_factory=dict)
    batches: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Upserted:
    rows_written: int
    rows_replaced: int


class KeyedTable:
    def __init__(self, spark: SparkSession, root: str, schema: StructType,
                 key: Sequence[str], part: Column, retention: float = RETENTION):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.key = list(key)
        self.part = part
        self.rule = str(part)
        self.retention = retention

    # -- reading ---------------------------------------------------------------------------

    def published(self) -> Published:
        """The latest published state. Its size is the number of parts, not of rows."""
        names = sorted(self._times("published"), reverse=True)
        version = next((n for n in names if is_written(
            self.spark, f"{self.root}/published/{_VERSION}={n}")), None)
        if version is None:
            return Published()
        state, rules = self._state(version)
        if rules - {self.rule}:
            raise ValueError(f"{self.root} has parts by {rules}, not by {self.rule}")
        return state

    def _times(self, kind: str) -> dict[int, float]:
        """Version numbers below a folder, with their times of change."""
        found = child_times(self.spark, f"{self.root}/{kind}")
        return {int(n.split("=")[1]): t for n, t in found.items() if n.startswith(f"{_VERSION}=")}

    def _state(self, version: int) -> tuple[Published, set[str]]:
        path = f"{self.root}/published/{_VERSION}={version}"
        rows = self.spark.read.schema(_PUBLISHED).parquet(path).collect()
        return Published(
            version,
            {r["part"]: r["data_version"] for r in rows if r["part"] is not None},
            {r["writer"]: r["batch_id"] for r in rows if r["writer"] is not None}), {
                r["rule"] for r in rows if r["rule"] is not None}

    def _rows(self, parts: dict[str, int]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        data = f"{self.root}/data"
        paths = [f"{data}/{_VERSION}={version}/{_PART}={part}" for part, version in sorted(parts.items())]
        return (self.spark.read.schema(self.schema).option("basePath", data).parquet(*paths)
                .select(*self.schema.names))

    def read(self) -> DataFrame:
        return self._rows(self.published().parts)

    # -- writing ---------------------------------------------------------------------------

    def upsert(self, rows: DataFrame, replaces: DataFrame | None = None,
               batch: tuple[str, int] | None = None) -> Upserted:
        """Replace the table's rows that have the key of a new row, and add the new rows.

        With ``replaces`` the rows matching its columns go instead: all rows of some hours, say,
        which also removes those that no longer come up. ``batch`` names the writer (a stream's
        own id, see ``writer_of``) and its batch; a batch that has been applied is not applied
        again.
        """
        state = self.published()
        if batch is not None and state.batches.get(batch[0], -1) >= batch[1]:
            return Upserted(0, 0)

        # Read three times: for its parts, for its keys and to be written.
        with stored_for_now(rows.select(*self.schema.names), "upsert", self.spark) as new:
            gone = new.select(*self.key) if replaces is None else replaces.distinct()
            return self._replace(state, new, gone, batch)

    def _replace(self, state: Published, new: DataFrame, gone: DataFrame,
                 batch: tuple[str, int] | None) -> Upserted:
        touched = {r[0] for r in self._part_of(new).union(self._part_of(gone)).distinct()
                   .collect()}
        if not touched:
            return Upserted(0, 0)
        old = self._rows({p: v for p, v in state.parts.items() if p in touched})
        kept = old.join(gone, gone.columns, "left_anti")
        version = state.version + 1
        target = f"{self.root}/data/{_VERSION}={version}"
        (kept.unionByName(new).withColumn(_PART, self.part).hint("rebalance", _PART)
         .write.mode("overwrite").option("compression", COMPRESSION).partitionBy(_PART)
         .parquet(target))

        parts = {p: v for p, v in state.parts.items() if p not in touched}
        parts |= {p: version for p in self._parts_below(target)}
        batches = state.batches | ({batch[0]: batch[1]} if batch else {})
        self._publish(version, parts, batches)
        # Counting stored rows reads file footers only.
        added, total = new.count(), self._stored(target).count()
        done = Upserted(rows_written=added, rows_replaced=old.count() + added - total)
        self._expire(version)
        return done

    def _part_of(self, rows: DataFrame) -> DataFrame:
        return rows.select(self.part.alias(_PART))

    def _parts_below(self, target: str) -> set[str]:
        """Parts that got files. An upsert may leave none, so the schema is given."""
        files = self._stored(target).inputFiles()
        return {f.rsplit(f"/{_PART}=", 1)[1].split("/", 1)[0] for f in files
                if f"/{_PART}=" in f}

    def _stored(self, target: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(target)

    def _publish(self, version: int, parts: dict[str, int], batches: dict[str, int]) -> None:
        """Publish a version; fails if another writer has published the same one meanwhile."""
        rows = [(None, None, None, None, self.rule)]
        rows += [(p, v, None, None, None) for p, v in parts.items()]
        rows += [(None, None, w, b, None) for w, b in batches.items()]
        (self.spark.createDataFrame(rows, _PUBLISHED).coalesce(1)
         .write.mode("error").parquet(f"{self.root}/published/{_VERSION}={version}"))

    def _expire(self, current: int) -> None:
        """Delete published states that were followed by another one long ago, and the data that
        only they point to. A data version is pointed to by states in a row, from its own on."""
        times = self._times("published")
        old, limit = sorted(v for v in times if v < current), time.time() - self.retention
        gone = [v for v, after in zip(old, [*old[1:], current]) if times[after] < limit]
        if not gone:
            return
        first = min(v for v in times if v not in gone)
        wanted = set(self._state(first)[0].parts.values())
        for version in self._times("data"):
            if version < first and version not in wanted:
                remove_tree(self.spark, f"{self.root}/data/{_VERSION}={version}")
        for version in gone:
            remove_tree(self.spark, f"{self.root}/published/{_VERSION}={version}")
