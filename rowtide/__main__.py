"""Command line: ``python -m rowtide stream|batch|control``; ``--help`` lists the options."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from rowtide.functions.casting import TIME_UNITS, TypeRules
from rowtide.operators.typed import SNAPSHOT_TS_MS
from rowtide.plans.batch import BatchJob, control_table, put_control, run_batch, run_days
from rowtide.session import build_session
from rowtide.sources.catalog import read_catalog, read_catalog_files
from rowtide.sources.control import read_control
from rowtide.sources.events import event_stream
from rowtide.sources.shards import EARLIEST, FORMAT, LATEST, shard_stream
from rowtide.spec import ARRIVAL, EVENT_ORDER
from rowtide.streaming.apply import ChangeApplier
from rowtide.streaming.job import BATCH_SECONDS, run_available, start_stream


def pairs(items: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def table_buckets(items: list[str]) -> dict[tuple[str, str], int]:
    return {tuple(name.split(".", 1)): int(n) for name, n in pairs(items).items()}


def names(items: list[str]) -> frozenset[tuple[str, str]]:
    return frozenset(tuple(item.split(".", 1)) for item in items)


DEFAULT_NAME = "rowtide"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rowtide")
    commands = top.add_subparsers(dest="command", required=True)

    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--name", default=DEFAULT_NAME, help="application name")
    common.add_argument("--root", required=True, help="folder of the lake tables")
    common.add_argument("--control-root", help="folder of the control table; default: --root")
    common.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE", help="Spark setting")

    job = argparse.ArgumentParser(add_help=False)
    job.add_argument("--catalog", help="Parquet files with the source column catalog")
    job.add_argument("--jdbc-url", help="source database to read the column catalog from instead")
    job.add_argument("--jdbc-properties", help="JSON file with user, password, driver")
    job.add_argument("--databases", nargs="*", default=[], help="source databases to list, with --jdbc-url")
    job.add_argument("--policy", choices=[EVENT_ORDER, ARRIVAL], default=EVENT_ORDER)
    job.add_argument("--buckets", type=int, help="buckets per table; default: by the size of its first load")
    job.add_argument("--table-buckets", action="append", default=[], metavar="DB.TABLE=N", help="for single tables")
    job.add_argument("--parallel", type=int, default=8, help="tables worked on at a time")
    job.add_argument("--datetime-type", choices=["timestamp", "timestamp_ntz"], default="timestamp")

    stream = commands.add_parser("stream", parents=[common, job], help="apply a stream of row changes")
    stream.add_argument("--format", required=True, help=f"streaming source, e.g. text, kafka, {FORMAT} (a folder per shard below --path)")
    stream.add_argument("--option", action="append", default=[], metavar="KEY=VALUE", help="source option")
    stream.add_argument("--path")
    stream.add_argument("--start", choices=[LATEST, EARLIEST], default=LATEST, help=f"where a new stream begins, with --format {FORMAT}")
    stream.add_argument("--value", default="value", help="column that holds the event text")
    stream.add_argument("--checkpoint", required=True)
    stream.add_argument("--every", type=int, default=BATCH_SECONDS, help="seconds per batch; 0: what is there, then stop")
    stream.add_argument("--batch-offset", type=int, default=0)
    stream.add_argument("--on-error", choices=["quarantine", "fail"], default="fail")
    stream.add_argument("--parse-tasks", type=int, help="spread the raw text over so many tasks")
    stream.add_argument("--time-unit", choices=sorted(TIME_UNITS), default="ms", help="what a bare number in date_action counts")
    stream.add_argument("--extra", action="append", default=[], help="further top-level event field to keep")
    stream.add_argument("--only", action="append", default=[], metavar="DB.TABLE", help="apply these tables only")
    stream.add_argument("--skip", action="append", default=[], metavar="DB.TABLE", help="leave these to another stream")

    stream.add_argument("--compact-after", type=int, default=20, help="merges of a table until its changes are folded into its rows")

    batch = commands.add_parser("batch", parents=[common, job], help="snapshot and daily loads that are due")
    batch.add_argument("--snapshots", required=True, help="path with {database} and {table}")
    batch.add_argument("--changes", required=True, help="root of the daily change files")
    batch.add_argument("--layout", choices=["hive", "plain"], default="hive")
    batch.add_argument("--unique-snapshots", action="store_true")
    batch.add_argument("--snapshot-ms", type=int, default=SNAPSHOT_TS_MS, help="when the snapshots were taken, in ms since 1970")
    batch.add_argument("--all-days", action="store_true", help="go on until no table's next day is there")

    control = commands.add_parser("control", parents=[common], help="put control rows from JSON files")
    control.add_argument("--rows", required=True)
    return top


def catalog(spark: SparkSession, args) -> DataFrame:
    if args.catalog:
        return read_catalog_files(spark, args.catalog)
    if not args.jdbc_url:
        raise SystemExit("--catalog or --jdbc-url is needed")
    properties = {}
    if args.jdbc_properties:
        with open(args.jdbc_properties) as f:
            properties = json.load(f)
    return read_catalog(spark, args.jdbc_url, args.databases, properties)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command == "stream" and (args.only or args.skip) and args.name == DEFAULT_NAME:
        raise SystemExit("streams that share a root (--only, --skip) each need a --name")
    if args.command == "stream" and args.format == FORMAT and not args.path:
        raise SystemExit(f"--format {FORMAT} needs a --path")
    spark = build_session(args.name, **pairs(args.conf))
    control = control_table(spark, args.control_root or args.root)
    if args.command == "control":
        put_control(control, read_control(spark, args.rows))
        return 0
    rules = TypeRules(datetime=args.datetime_type)
    if args.command == "batch":
        job = BatchJob(
            args.root, args.snapshots, args.changes, args.layout, args.policy,
            table_buckets(args.table_buckets), args.buckets, rules, parallel=args.parallel,
            unique_snapshots=args.unique_snapshots, snapshot_ts_ms=args.snapshot_ms,
        )
        run = run_days if args.all_days else run_batch
        outcome = run(spark, job, control, catalog(spark, args))
        for database, table in outcome.absent:
            print(f"{database}.{table}: its day is not there yet", file=sys.stderr)
        for (database, table), error in outcome.failed:
            print(f"{database}.{table}: {type(error).__name__}: {error}", file=sys.stderr)
        return 1 if outcome.failed else 0
    applier = ChangeApplier(
        spark, args.root, control.read, lambda: catalog(spark, args), args.policy, rules, args.datetime_type,
        table_buckets(args.table_buckets), args.buckets, args.parallel, args.parse_tasks,
        args.on_error, names(args.only), names(args.skip),
        tuple(args.extra), name=args.name, batch_offset=args.batch_offset, time_unit=args.time_unit,
        compact_after=args.compact_after,
    )
    if args.format == FORMAT:
        source = shard_stream(spark, args.path, args.checkpoint, args.start)
    else:
        source = event_stream(spark, args.format, args.value, args.path, **pairs(args.option))
    if args.every == 0:
        run_available(source, applier, args.checkpoint, args.name)
    else:
        query, _ = start_stream(source, applier, args.checkpoint, args.every, args.name)
        query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
