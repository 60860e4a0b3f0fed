"""Entry points for `spark-submit`.

    jobs.py batch  --input DIR_OR_CSV --output ROOT [--months 7,8] [--parquet]
    jobs.py events --input DIR_OR_CSV --output DIR  [--months 7,8] [--parquet]
    jobs.py stream --events DIR --alerts DIR --stats DIR --corrupt DIR --checkpoint DIR
                   [--window-size 300] [--once] [--max-idle SECONDS]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from meterwell import session
from meterwell.operators.events import usage_events
from meterwell.plans.pipeline import run_pipeline, written_counts
from meterwell.settings import DEFAULTS
from meterwell.sources.messages import stream_event_files, write_event_files
from meterwell.sources.wide_csv import read_wide_csv
from meterwell.streaming.one_pass import OnePass, run_until_idle, start_one_pass


def _spark(settings: dict[str, str]) -> SparkSession:
    """A session of its own with these settings where the submit command gave none."""
    spark = SparkSession.builder.appName("meterwell").getOrCreate().newSession()
    given = spark.sparkContext.getConf()
    for key, value in settings.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    return spark


def _wide(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return spark.read.parquet(args.input) if args.parquet else read_wide_csv(spark, args.input)


def batch(args: argparse.Namespace) -> None:
    spark = _spark(session.BATCH)
    months = DEFAULTS.labels_for(args.months) if args.months else None
    written: dict[str, int] = {}
    run_pipeline(_wide(spark, args), args.output, months=months, written=written)
    written_counts(spark, written).show(truncate=False)


def events(args: argparse.Namespace) -> None:
    spark = _spark(session.BATCH)
    rows = usage_events(_wide(spark, args), months=DEFAULTS.labels_for(args.months))
    write_event_files(rows, args.output)


def stream(args: argparse.Namespace) -> None:
    """One query for all results; it keeps its tables beside its checkpoint.

    With `--once` it works through what is there, with `--max-idle` it ends when no
    line came for so long and closes the last windows, else it runs on.
    """
    spark = _spark(session.STREAM)
    decoded = stream_event_files(spark, args.events)
    state = f"{args.checkpoint.rstrip('/')}/tables"
    sink = OnePass(state, args.alerts, args.stats, args.corrupt, window_seconds=args.window_size)
    checkpoint = f"{args.checkpoint.rstrip('/')}/query"
    if args.max_idle is not None:
        run_until_idle(decoded, sink, checkpoint, args.max_idle)
    else:
        start_one_pass(decoded, sink, checkpoint, args.once).awaitTermination()


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="jobs.py")
    jobs = parser.add_subparsers(required=True)
    for run in (batch, events):
        job = jobs.add_parser(run.__name__)
        job.add_argument("--input", required=True)
        job.add_argument("--output", required=True)
        job.add_argument("--months")
        job.add_argument("--parquet", action="store_true")
        job.set_defaults(run=run)
    job = jobs.add_parser("stream")
    for name in ("--events", "--alerts", "--stats", "--corrupt", "--checkpoint"):
        job.add_argument(name, required=True)
    job.add_argument("--window-size", type=int, default=DEFAULTS.window_seconds)
    how = job.add_mutually_exclusive_group()
    how.add_argument("--once", action="store_true")
    how.add_argument("--max-idle", type=float)
    job.set_defaults(run=stream)
    args = parser.parse_args(argv)
    args.run(args)


if __name__ == "__main__":
    main()
