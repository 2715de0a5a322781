"""Jobs for spark-submit: clean, gate, warehouse, run, events, replay, notices.

    spark-submit submit.py run --raw … --curated … --warehouse … --checkpoint … --database shop

The session comes from spark-submit. A failed quality gate or, with --strict, a file without valid
events ends the job with an error. The gate takes a folder or, with --table, a name in the catalog.
"""

import argparse
import datetime
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from tillroll.operators.quality import (
    MaxNullRate,
    MinRows,
    MinTotal,
    YearsPresent,
    dead_letter_check,
    enforce,
)
from tillroll.plans.catalog import register_curated, register_events, register_warehouse
from tillroll.plans.lake import build_warehouse, failed_runs, gate, run_lake, table_checks
from tillroll.sinks.events import ingest_events, read_dead_letters
from tillroll.sources.orders import read_curated
from tillroll.streaming.events import run_event_ingest
from tillroll.streaming.orders import run_incremental


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="submit.py")
    jobs = root.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str) -> argparse.ArgumentParser:
        added = jobs.add_parser(name)
        for path in paths:
            added.add_argument(f"--{path}", required=True)
        added.add_argument("--database")
        return added

    def with_rules(added: argparse.ArgumentParser) -> None:
        added.add_argument("--min-rows", type=int, default=MinRows.minimum)
        added.add_argument("--max-null-rate", type=float, default=MaxNullRate.maximum)
        added.add_argument("--min-revenue", type=float, default=MinTotal.minimum)
        added.add_argument("--years", nargs="+", default=list(YearsPresent.years))

    job("clean", "raw", "curated", "checkpoint").add_argument("--archive")
    judged = job("gate")
    judged.add_argument("--curated")
    judged.add_argument("--table")
    with_rules(judged)
    job("warehouse", "curated", "warehouse")
    whole = job("run", "raw", "curated", "warehouse", "checkpoint")
    whole.add_argument("--run-log")
    whole.add_argument("--archive")
    with_rules(whole)
    arriving = job("events", "incoming", "out", "checkpoint")
    arriving.add_argument("--strict", action="store_true")
    arriving.add_argument("--pattern", default="*.json")
    job("notices", "run-log")
    replay = job("replay", "out")
    replay.add_argument("files", nargs="+")
    replay.add_argument("--strict", action="store_true")
    return root


def rules(args: argparse.Namespace) -> tuple:
    return (
        MinRows(args.min_rows),
        MaxNullRate(maximum=args.max_null_rate),
        MinTotal(minimum=args.min_revenue),
        YearsPresent(tuple(args.years)),
    )


def clean(spark: SparkSession, args: argparse.Namespace) -> dict:
    run = run_incremental(spark, args.raw, args.curated, args.checkpoint, archive=args.archive)
    if args.database and run.files:
        register_curated(spark, args.database, args.curated)
    return {"message": run.message(), **vars(run)}


def judge(spark: SparkSession, args: argparse.Namespace) -> dict:
    if args.table:
        return enforce(table_checks(spark, args.table, rules(args)))
    if not args.curated:
        raise SystemExit("gate: give --curated or --table")
    return gate(read_curated(spark, args.curated), rules(args))


def warehouse(spark: SparkSession, args: argparse.Namespace) -> dict:
    counts = build_warehouse(spark, args.curated, args.warehouse)
    if args.database:
        register_warehouse(spark, args.database, args.warehouse)
    return counts


def whole_run(spark: SparkSession, args: argparse.Namespace) -> dict:
    record = run_lake(
        spark,
        args.raw,
        args.curated,
        args.warehouse,
        args.checkpoint,
        database=args.database,
        rules=rules(args),
        run_log=args.run_log,
        archive=args.archive,
    )
    return vars(record)


def events(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Ingest what is new; the alert says whether dead letters came with it."""
    since = datetime.datetime.now(datetime.timezone.utc)
    totals = run_event_ingest(spark, args.incoming, args.out, args.checkpoint, pattern=args.pattern)
    if args.database and totals["files"]:
        register_events(spark, args.database, args.out)
    alert = dead_letter_check(read_dead_letters(spark, args.out), since)
    if args.strict:
        enforce(alert)
    return {**totals, "alert": alert.first().asDict()}


def notices(spark: SparkSession, args: argparse.Namespace) -> dict:
    """The newest failed run, and how many there are."""
    failed = failed_runs(spark, args.run_log)
    newest = failed.first()
    return {"failed_runs": failed.count(), "newest": newest and newest.message}


def replay(spark: SparkSession, args: argparse.Namespace) -> dict:
    return ingest_events(spark, args.files, args.out, strict=args.strict)


JOBS = {
    "clean": clean,
    "gate": judge,
    "warehouse": warehouse,
    "run": whole_run,
    "events": events,
    "replay": replay,
    "notices": notices,
}


def main(argv: list[str] | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"tillroll-{args.job}").getOrCreate()
    result = JOBS[args.job](spark, args)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()
