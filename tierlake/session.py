"""Session options and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

Item = TypeVar("Item")
Result = TypeVar("Result")

# Options the operators rely on. Everything sized to a cluster (shuffle width, memory, split
# size) stays with the caller or with AQE.
RUNTIME_OPTIONS = {
    # hour() and to_date() follow the session zone while window() is aligned to the UTC epoch.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A task that writes to so few partitions of a table opens a file for each; by default, and
    # beyond that number, it sorts its rows by partition first, in full width.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}

#: Of all stored tables: texts that are repeated within a page take next to no room.
COMPRESSION = "zstd"


def build_session(app_name: str, master: str | None = None, **options: str) -> SparkSession:
    """Create a session with the options above; the master is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**RUNTIME_OPTIONS, **options}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_runtime_options(spark: SparkSession) -> SparkSession:
    """Set the options above on a session somebody else created (all are runtime-settable)."""
    for key, value in RUNTIME_OPTIONS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder would lose data with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tierlake-"))
        folder = context.getCheckpointDir()
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, spark: SparkSession | None = None) -> DataFrame:
    """Write a derived table to the shared folder and read it back.

    Cuts the lineage in a way that survives lost executors, and unlike ``checkpoint()`` keeps
    column pruning and filter pushdown for whatever reads it next. A micro-batch belongs to a
    session of its own with other options; ``spark`` names the session to read back in. The
    files stay, as the frame may be used at any later time; give the shared folder an expiry.
    """
    spark = df.sparkSession if spark is None else spark
    return _write_and_read(df, scratch_path(spark, label), spark)


def _write_and_read(df: DataFrame, path: str, spark: SparkSession) -> DataFrame:
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stored_for_now(df: DataFrame, label: str, spark: SparkSession) -> Iterator[DataFrame]:
    """Like ``materialise``, for use inside the block only: then the files are removed, so that a
    stream does not fill the shared folder."""
    path = scratch_path(spark, label)
    try:
        yield _write_and_read(df, path, spark)
    finally:
        remove_tree(spark, path)


def _file_system(spark: SparkSession, path: str) -> tuple:
    """Hadoop's path object and the file system it is on."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_tree(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is on."""
    folder, files = _file_system(spark, path)
    files.delete(folder, True)


def tree_bytes(spark: SparkSession, path: str) -> int:
    """The size of all files below a path."""
    folder, files = _file_system(spark, path)
    return files.getContentSummary(folder).getLength()


def child_times(spark: SparkSession, path: str) -> dict[str, float]:
    """Names of the folders right below a path, with their times of change in seconds."""
    folder, files = _file_system(spark, path)
    if not files.exists(folder):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000
            for s in files.listStatus(folder) if s.isDirectory()}


def is_written(spark: SparkSession, path: str) -> bool:
    """Whether a Spark job has written a folder to its end."""
    marker, files = _file_system(spark, f"{path.rstrip('/')}/_SUCCESS")
    return files.exists(marker)


def ensure_folder(spark: SparkSession, path: str) -> None:
    """Create a folder unless it is there: a stream can then start before its first file."""
    folder, files = _file_system(spark, path)
    files.mkdirs(folder)


def run_together(spark: SparkSession, action: Callable[[Item], Result],
                 items: Iterable[Item]) -> list[Result]:
    """Run an action that starts Spark jobs for several tables at the same time.

    The jobs do not depend on each other, so tasks of one fill the executors that the last
    tasks of another leave idle. Results come in the order of the items.
    """
    items = list(items)
    with ThreadPoolExecutor(max(len(items), 1)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(action), items))
