"""Control-driven batch job: snapshot loads for new tables, daily change files for the others."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.frames import small_frame
from rowtide.functions.casting import TypeRules
from rowtide.functions.keys import any_null
from rowtide.operators.events import DEBEZIUM_DELETES, DEBEZIUM_UPSERTS, REJECT, SIDE, tag_debezium
from rowtide.operators.merge import as_changes
from rowtide.operators.typed import BATCH_LABEL, SNAPSHOT_TS_MS, null_fill, stamp_snapshot, typed_columns
from rowtide.plans.tables import for_each, table_columns
from rowtide.schemas import CONTROL
from rowtide.sinks.quarantine import quarantine_rows, write_quarantine
from rowtide.sinks.table import DATABASE_PREFIX, LakeTable
from rowtide.sources.control import CONTROL_KEYS, advance, due
from rowtide.sources.files import DAY, available_days, read_changes_for_days, read_snapshot
from rowtide.spec import BATCH, BATCH_ORDER, EVENT_ORDER, TableSpec, split_keys


log = logging.getLogger(__name__)

DAYS_AT_ONCE = 366


@dataclass(frozen=True)
class BatchJob:
    root: str
    snapshots: str  # path with {database} and {table}
    changes: str  # root of the daily change files
    layout: str = "hive"
    policy: str = EVENT_ORDER
    buckets: Mapping[tuple[str, str], int] = field(default_factory=dict)
    default_buckets: int | None = None  # None: from the size of a table's first load
    rules: TypeRules = TypeRules()
    label: str = BATCH_LABEL
    upserts: tuple[str, ...] = DEBEZIUM_UPSERTS
    deletes: tuple[str, ...] = DEBEZIUM_DELETES
    parallel: int = 8
    unique_snapshots: bool = False  # True: no export repeats a key, so merges need one shuffle less
    prefix: str = DATABASE_PREFIX
    name: str = "batch"  # what quarantined rows are filed under; streams have names of their own
    snapshot_ts_ms: int = SNAPSHOT_TS_MS  # when the snapshots were taken; changes before it lose to them
    compact_after: int = 20  # days until a table's changes are folded into its rows

    def spec(self, database: str, table: str, table_id: str) -> TableSpec:
        return TableSpec(
            database,
            table,
            split_keys(table_id),
            BATCH_ORDER,
            self.buckets.get((database, table), self.default_buckets),
            self.policy,
        )

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"


def snapshot_rows(snapshot: DataFrame, table: str, columns, label: str = BATCH_LABEL, ts_ms: int = SNAPSHOT_TS_MS) -> DataFrame:
    """Stamp, fill, type: one projection over the snapshot files."""
    return typed_columns(null_fill(stamp_snapshot(snapshot, table, ts_ms)), columns, label)


def load_snapshot(spark: SparkSession, job: BatchJob, spec: TableSpec, columns) -> LakeTable:
    source = read_snapshot(spark, job.snapshots, spec.database, spec.table)
    rows = snapshot_rows(source, spec.table, columns, job.label, job.snapshot_ts_ms)
    keyless = Observation()
    seen = rows.observe(keyless, F.count_if(any_null(spec.keys)).alias("n"))
    lake = LakeTable(spark, job.root, spec)
    lake.bulk_load(seen.filter(~any_null(spec.keys)), unique=job.unique_snapshots)
    if keyless.get["n"]:
        _quarantine(job, spec, rows.filter(any_null(spec.keys)), F.lit("null_key"), 0)
    lake.register(job.prefix)
    return lake


def _quarantine(job: BatchJob, spec: TableSpec, bad: DataFrame, reason: Column, number: int) -> None:
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in bad.columns if c != SIDE]))
    named = bad.withColumns(
        {"_text": text, "_why": reason, "schema": F.lit(spec.database), "table": F.lit(spec.table)}
    )
    origin = f"{spec.database}.{spec.table}"
    rows = quarantine_rows(named, F.col("_why"), number, origin, F.col("_text"), job.name)
    write_quarantine(rows, job.quarantine)


def daily_changes(day_rows: DataFrame, spec: TableSpec, columns, job: BatchJob) -> DataFrame:
    """Typed and tagged; daily rows get the same types as snapshot rows."""
    tagged = tag_debezium(day_rows, upserts=job.upserts, deletes=job.deletes)
    order = [(c, "bigint") for c in spec.order]
    typed = typed_columns(tagged, [*columns, *order], job.label)
    return typed.withColumn("__table", F.lit(spec.table))


def apply_days(spark: SparkSession, job: BatchJob, spec: TableSpec, columns, days: dict[dt.date, str]) -> LakeTable:
    """Days of change files (``sources.files.available_days``) in one merge; a row's day is its batch, as in a merge of its own."""
    number = max(days).toordinal()
    day = F.unix_date(F.col(DAY)) + dt.date(1970, 1, 1).toordinal()
    rows = read_changes_for_days(spark, days).withColumn(BATCH, day.cast("bigint")).drop(DAY)
    tagged = daily_changes(rows, spec, columns, job)
    rejected = (F.col(SIDE) == REJECT) | any_null(spec.keys)
    found = Observation()
    seen = tagged.observe(found, F.count_if(rejected).alias("n"))
    lake = LakeTable(spark, job.root, spec)
    lake.merge(as_changes(seen, spec.keys, spec.order), number)
    if found.get["n"]:  # only then are the files read a second time
        reason = F.when(F.col(SIDE) == REJECT, "unknown_operation").otherwise("null_key")
        _quarantine(job, spec, tagged.filter(rejected).drop(BATCH), reason, number)
    if len(lake.change_folders()) >= job.compact_after:
        lake.compact()
    if lake.schema is not None:  # else no day has brought a row yet
        lake.register(job.prefix)
    return lake


def apply_day(spark: SparkSession, job: BatchJob, spec: TableSpec, columns, day: dt.date) -> LakeTable:
    days = available_days(spark, job.changes, spec.database, spec.table, day, job.layout, 1)
    if not days:
        raise FileNotFoundError(f"no change files of {spec.database}.{spec.table} for {day} below {job.changes}")
    return apply_days(spark, job, spec, columns, days)


@dataclass
class Outcome:
    """What one pass over the control table did, by table."""

    done: list[tuple[str, str]] = field(default_factory=list)
    days: dict[tuple[str, str], int] = field(default_factory=dict)  # how far each of them has moved on
    absent: list[tuple[str, str]] = field(default_factory=list)  # the day has not been delivered yet
    failed: list[tuple[tuple[str, str], Exception]] = field(default_factory=list)


class _Stopped(Exception):
    """A table that has failed after some of its days."""

    def __init__(self, days: int, error: Exception):
        super().__init__(str(error))
        self.days, self.error = days, error


def run_batch(spark: SparkSession, job: BatchJob, control: LakeTable, catalog: DataFrame, most: int = 1) -> Outcome:
    """One pass over the control table: one snapshot, or up to ``most`` days in one merge, for each table.

    Tables move on by the days that have succeeded, in one write for all of them. A table whose day is absent stays where
    it is, and gets that day once it is there. Where a merge of several days fails, they are tried one by one.
    """
    rows = due(control.read())
    tables = rows.select(F.col("database").alias("schema"), "table")
    columns = table_columns(tables, catalog, job.rules)

    def work(row) -> int:
        name = (row["database"], row["table"])
        if name not in columns:
            raise LookupError(f"no catalog columns for {name[0]}.{name[1]}")
        spec = job.spec(*name, row["table_id"])
        if row["first_load"]:
            load_snapshot(spark, job, spec, columns[name])
            return 1
        days = available_days(spark, job.changes, *name, row["load_date"], job.layout, most)
        if not days:
            raise FileNotFoundError(f"no change files of {name[0]}.{name[1]} for {row['load_date']} below {job.changes}")
        try:
            apply_days(spark, job, spec, columns[name], days)
        except Exception:
            if len(days) == 1:
                raise
            log.warning("%s.%s: days %s to %s one by one", *name, min(days), max(days), exc_info=True)
            for n, day in enumerate(sorted(days)):
                try:
                    apply_days(spark, job, spec, columns[name], {day: days[day]})
                except Exception as error:
                    raise _Stopped(n, error) from error
        return len(days)

    out = Outcome()
    for r, days, error in for_each(spark, rows.collect(), work, job.parallel):  # one small metadata row per table
        name = (r["database"], r["table"])
        if isinstance(error, _Stopped):
            days, error = error.days, error.error
        if days:
            out.done.append(name)
            out.days[name] = days
        if isinstance(error, FileNotFoundError):
            log.info("%s", error)
            out.absent.append(name)
        elif error is not None:
            out.failed.append((name, error))
    if out.done:
        moved = [(*name, days) for name, days in out.days.items()]
        finished = small_frame(spark, moved, T.StructType([*CONTROL.fields[:2], T.StructField("_days", T.IntegerType())]))
        put_control(control, advance(control.read().join(finished, list(CONTROL_KEYS)), F.col("_days")))
    return out


def run_days(spark: SparkSession, job: BatchJob, control: LakeTable, catalog: DataFrame, most: int = DAYS_AT_ONCE) -> Outcome:
    """Passes until no table moves on: every table ends before its first day that is absent or fails."""
    out = run_batch(spark, job, control, catalog, most)
    while out.done:
        out = run_batch(spark, job, control, catalog, most)
    return out


def control_table(spark: SparkSession, root: str) -> LakeTable:
    """The control table is itself a keyed table: a put replaces the whole row of its key."""
    return LakeTable(spark, root, TableSpec("meta", "control", CONTROL_KEYS, ("last_date",), 1, "arrival"))


def put_control(control: LakeTable, rows: DataFrame) -> None:
    control.merge(rows.withColumn("_deleted", F.lit(False)), control.next_batch())
