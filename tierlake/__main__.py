"""Command line: ``python -m tierlake <job> --lake PATH [--kafka SERVERS | --files PATH]``."""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tierlake.plans import incremental, jobs
from tierlake.schemas import TOPICS
from tierlake.session import build_session
from tierlake.sources.messages import FileLog, KafkaLog, MessageLog
from tierlake.sources.tables import table_stream
from tierlake.streaming.clean_log import CleanLog, stream_clean
from tierlake.streaming.metrics import HOURLY, metric_table, stream_hourly
from tierlake.streaming.profiles import profile_table, stream_profiles
from tierlake.streaming.raw import stream_raw
from tierlake.streaming.run import EVERY_30_S, EVERY_60_S, wait_for

JOBS = ("raw", "clean", "metrics", "full", "incremental", "profiles")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tierlake", description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--mode", choices=("batch", "stream"), default="batch")
    parser.add_argument("--lake", required=True, help="root folder of the layers")
    parser.add_argument("--kafka", help="bootstrap servers of the topics")
    parser.add_argument("--files", help="root of topics archived as Parquet")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="time of the snapshots")
    parser.add_argument("--mask", action="store_true", help="mask personal data when cleaning")
    parser.add_argument("--salt", help="with --mask, replace user ids by a salted digest")
    parser.add_argument("--limit", type=int, help="profiles of the first N users only")
    args = parser.parse_args(argv)
    # A flag that a job does not use must not look as if it had worked.
    if args.mask and args.job not in ("clean", "full", "incremental"):
        parser.error("--mask belongs to the jobs that write clean tables: clean, full, incremental")
    if args.salt and not args.mask:
        parser.error("--salt needs --mask")
    if args.limit is not None and (args.job != "profiles" or args.mode == "stream"):
        parser.error("--limit belongs to the profiles batch job")
    return args


def _message_log(args: argparse.Namespace) -> MessageLog:
    if args.kafka:
        return KafkaLog(args.kafka)
    if args.files:
        return FileLog(args.files)
    raise SystemExit("this job reads topics: give --kafka or --files")


def _batch(spark: SparkSession, args: argparse.Namespace) -> int:
    lake = jobs.Lake(args.lake)
    if args.job == "raw":
        outcomes = jobs.raw_job(spark, _message_log(args), lake)
    elif args.job == "clean":
        outcomes = jobs.clean_job(spark, lake, masked=args.mask, salt=args.salt)
    elif args.job == "metrics":
        outcomes = jobs.metrics_job(spark, lake, args.as_of)
    elif args.job == "profiles":
        outcomes = [jobs.profiles_job(spark, lake, args.as_of, args.limit)]
    elif args.job == "incremental":
        outcomes = incremental.incremental_job(
            spark, _message_log(args), incremental.incremental_lake(args.lake),
            as_of=args.as_of, masked=args.mask, salt=args.salt)
    else:
        outcomes = jobs.full_job(spark, _message_log(args), lake, as_of=args.as_of,
                                 masked=args.mask, salt=args.salt)
    for outcome in outcomes:
        print(outcome)
    return 1 if jobs.failed(outcomes) else 0


def _stream(spark: SparkSession, args: argparse.Namespace) -> int:
    lake = jobs.Lake(args.lake, "stream")
    logs = {f: CleanLog(spark, lake.path("clean", f), f) for f in TOPICS}

    def checkpoint(layer: str, name: str) -> str:
        return lake.path(f"checkpoints/{layer}", name)

    if args.job == "raw":
        source = _message_log(args)
        queries = [stream_raw(spark, source, t, lake.path("raw", f), checkpoint("raw", f),
                              EVERY_30_S) for f, t in TOPICS.items()]
    elif args.job == "clean":
        queries = [stream_clean(table_stream(spark, lake.path("raw", f), t.raw), logs[f],
                                checkpoint("clean", f), EVERY_60_S, args.mask, args.salt)
                   for f, t in TOPICS.items()]
    elif args.job == "metrics":
        queries = [stream_hourly(logs, n, metric_table(spark, lake.path("metrics", n), n),
                                 checkpoint("metrics", n), EVERY_60_S) for n in HOURLY]
    elif args.job == "profiles":
        def segments() -> DataFrame:
            return jobs.read_metric(spark, jobs.Lake(args.lake), "user_segments")

        queries = [stream_profiles(
            logs, segments, profile_table(spark, lake.path("profiles", "user_profiles")),
            checkpoint("profiles", "user_profiles"), EVERY_60_S, args.as_of)]
    else:
        raise SystemExit("start the raw, clean and metrics streams separately; incremental is a "
                         "batch job")
    wait_for(queries)
    return 0


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = build_session(f"tierlake-{args.job}")
    try:
        return _batch(spark, args) if args.mode == "batch" else _stream(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
