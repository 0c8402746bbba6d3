"""Applies micro-batches of row-change events to the lake tables they belong to."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import files
from rowtide.frames import small_frame
from rowtide.functions.casting import TypeRules
from rowtide.functions.keys import any_null
from rowtide.operators.events import REASON, SIDE, parse_events, tag_binlog
from rowtide.operators.latest import preview_topn
from rowtide.operators.merge import as_changes
from rowtide.operators.typed import STREAM_LABEL, row_column, typed_events
from rowtide.plans.tables import NAME, Name, for_each, table_columns
from rowtide.plans.together import SmallTable, groups, merge_together, null_key, typed_together
from rowtide.schemas import VALUES_MAP
from rowtide.sinks.metrics import COUNT, append_metrics, metric_row
from rowtide.sinks.quarantine import quarantine_rows, write_quarantine
from rowtide.sinks.table import DATABASE_PREFIX, LakeTable
from rowtide.sources.control import CONTROL_KEYS, key_lookup, stored_rows
from rowtide.sources.events import spread
from rowtide.spec import EVENT_ORDER, STREAM_ORDER, TableSpec, split_keys

log = logging.getLogger(__name__)

_OK = "_ok"
_LOST = "_lost"
_WHERE = "_where"  # registered tables only: names out of event text are no folders
_PARTS = (_OK, _WHERE)
_LISTED = ("schema", "table", "table_id")
_SHARE = "_share"
SHARES = 16  # parts in which a table's rows of a batch are dealt; small ones meet again in one task
DIRECT_TABLES = 8  # up to so many registered tables, a batch in many splits is staged as it comes


@dataclass
class ChangeApplier:
    """``foreachBatch`` function: parse once, stage by table, one job for all small tables and one for each large one.

    The staged batch is the only pass over the source. Every table reads its own partition of it,
    so the batch is not scanned once per table, and a lost executor costs no second read of the
    source. ``control`` and ``catalog`` are called for every batch.
    """

    spark: SparkSession
    root: str
    control: Callable[[], DataFrame]
    catalog: Callable[[], DataFrame]
    policy: str = EVENT_ORDER
    rules: TypeRules = TypeRules()
    time_type: str = "timestamp"
    buckets: Mapping[Name, int] = field(default_factory=dict)
    default_buckets: int | None = None  # None: from the size of a table's first load
    parallel: int = 8
    parse_tasks: int | None = None  # for uneven shards: spread the raw text over so many tasks
    on_error: str = "fail"  # the batch is replayed from the checkpoint; or "quarantine": the stream goes on
    only: frozenset[Name] = frozenset()  # a stream of its own for tables worth longer batches,
    skip: frozenset[Name] = frozenset()  # which the other stream then leaves out
    extras: tuple[str, ...] = ()  # further top-level event fields to keep as text columns
    label: str = STREAM_LABEL
    prefix: str | None = DATABASE_PREFIX  # None: tables are not shown in the catalog
    name: str = "changes"  # streams that share a root need names of their own
    batch_offset: int = 0  # raise it above the last batch when a checkpoint starts anew
    time_unit: str = "ms"  # what a bare number in date_action counts
    compact_after: int = 20  # merges of a table until its changes are folded into its rows
    together_rows: int = 100_000  # tables with fewer rows in a batch share its jobs; 0: each has jobs of its own
    rest: str | None = None  # a column for the fields that the catalog lacks, as JSON text; tables then have jobs of their own
    _lakes: dict[TableSpec, LakeTable] = field(default_factory=dict)
    _unregistered: list[Name] = field(default_factory=list)
    _lost: dict[Name, int] = field(default_factory=dict)

    @property
    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def metrics_path(self) -> str:
        return f"{self.root}/metrics"

    @property
    def _event_columns(self) -> tuple[str, ...]:
        return ("schema", "table", "log_type", *STREAM_ORDER, *self.extras)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch_id += self.batch_offset
        stage = f"{self.root}/stage/{self.name}/batch-{batch_id}"
        self.stage(batch, stage)
        if not any(n.startswith(_OK) for n in files.child_names(self.spark, stage)):
            files.delete(self.spark, stage)  # an empty batch wrote no partition
            return
        staged = self.spark.read.schema(self._stage_schema).parquet(stage)
        # one row per registered table of the batch, with its key columns, and one for all the rest
        named = [F.when(F.col(_OK), F.col(c)).alias(c) for c in _LISTED]
        listed = staged.groupBy(_OK, *named).count().collect()
        good = {(r["schema"], r["table"]): r for r in listed if r[_OK]}
        log.info("batch %s: %s rows of %s tables", batch_id, sum(r["count"] for r in listed), len(good))
        if log.isEnabledFor(logging.DEBUG):
            first = preview_topn(staged, ["date_action", "schema", "table"], STREAM_ORDER)
            log.debug("batch %s starts with %s", batch_id, first.collect())
        bad = sum(r["count"] for r in listed if not r[_OK])
        if bad:
            reject = staged.filter(~F.col(_OK))
            rows = quarantine_rows(reject, F.col(REASON), batch_id, "parse", F.col("value"), self.name)
            write_quarantine(rows, self.quarantine_path)
        keys = {n: split_keys(r["table_id"]) for n, r in good.items()}
        counts = {n: r["count"] for n, r in good.items()}
        failed = self._apply_tables(staged, keys, counts, batch_id) if good else {}
        self._report({n: r["count"] for n, r in good.items()}, bad, failed, batch_id)
        if failed and self.on_error == "fail":
            raise RuntimeError(f"batch {batch_id} failed for {sorted(failed)}") from next(iter(failed.values()))
        files.delete(self.spark, stage)

    def stage(self, batch: DataFrame, path: str) -> None:
        """Parsed batch as Parquet by table. ``rebalance`` splits the rows of a hot table over
        several tasks and gives small tables one file each.

        With few registered tables, a batch that comes in ``parse_tasks`` splits or more isn't moved at all: each task
        keeps a file of every table open, and sorts only what goes beyond that many."""
        raw = spread(batch, self.parse_tasks)
        events = self._own(parse_events(raw, "value", self.time_type, self.extras, T.StringType(), self.time_unit))
        # Rows of unregistered tables leave with the other rejects: whatever names events hold, they are one write.
        control = stored_rows(self.control().select(*[F.col(c).cast("string") for c in (*CONTROL_KEYS, "table_id")]), f"{path}-control")
        events = key_lookup(events, control)
        reason = F.coalesce(F.col(REASON), F.when(F.coalesce("table_id", F.lit("")) == "", "no_key"))
        events = events.withColumn(REASON, reason)
        keep_text = F.when(F.col(REASON).isNotNull(), F.col("value")).alias("value")
        ok = F.col(REASON).isNull()
        out = events.select(
            "log_type", "date_action", "log_position", "values", *self.extras, keep_text, REASON, *_LISTED,
            ok.alias(_OK), F.when(ok, F.concat_ws(".", "schema", "table")).alias(_WHERE),
        )
        self._stage_schema = out.schema
        if self.parse_tasks is not None and raw is batch and control.count() <= DIRECT_TABLES:
            _write_direct(out, path)
        else:
            dealt = out.withColumn(_SHARE, F.pmod(F.xxhash64("values", "value"), F.lit(SHARES)).cast("byte"))
            _write_stage(dealt.hint("rebalance", *_PARTS, _SHARE).drop(_SHARE), path)
        files.delete(self.spark, f"{path}-control")

    def _own(self, events: DataFrame) -> DataFrame:
        """Events of this stream's tables; what has no table belongs to the stream without ``only``."""
        def named(names: frozenset[Name]) -> Column:
            hits = [(F.col("schema") == s) & (F.col("table") == t) for s, t in sorted(names)]
            return F.coalesce(reduce(Column.__or__, hits, F.lit(False)), F.lit(False))

        if self.only:
            events = events.filter(named(self.only))
        return events.filter(~named(self.skip)) if self.skip else events

    def _apply_tables(self, staged: DataFrame, keys: dict[Name, tuple], counts: dict[Name, int], batch_id: int) -> dict[Name, Exception]:
        columns = table_columns(small_frame(self.spark, list(keys), NAME), self.catalog(), self.rules)
        known = {n: self._table(n, keys[n], columns[n]) for n in keys if n in columns}
        if len(known) < len(keys):
            strangers = small_frame(self.spark, [n for n in keys if n not in known], NAME)
            rows = staged.filter(F.col(_OK)).join(strangers, ["schema", "table"], "left_semi")
            self._quarantine(rows, "no_catalog", None, batch_id)
        small = [t for n, t in known.items() if counts[n] <= self.together_rows and self.rest is None and self._fits(t)]
        shared = [g for g in groups(small, self._keep) if len(g) > 1]
        single = known.keys() - {t.name for g in shared for t in g}

        def work(tables: list[SmallTable]) -> None:
            if len(tables) == 1:
                self._merge(_rows_of(staged, tables[0].name), tables[0], batch_id)
            else:
                self._merge_together(staged, tables, batch_id)

        def one_by_one(jobs: list[list[SmallTable]]) -> list:
            return for_each(self.spark, jobs, work, self.parallel)

        results = one_by_one([*shared, *([known[n]] for n in sorted(single))])
        # what spoils a shared job is one of its tables: each has another try on its own
        again = [[t] for tables, _, error in results if error is not None and len(tables) > 1 for t in tables]
        results = [r for r in results if r[2] is None or len(r[0]) == 1] + one_by_one(again)
        failed = {tables[0].name: error for tables, _, error in results if error is not None}
        merged = [t for tables, _, error in results if error is None for t in tables]
        for table, _, error in for_each(self.spark, merged, self._settle, self.parallel):
            if error is not None:
                failed[table.name] = error
        if self.on_error == "quarantine":
            for name, error in failed.items():
                self._quarantine(_rows_of(staged, name), f"write_failed: {type(error).__name__}", name, batch_id)
        return failed

    @property
    def _keep(self) -> tuple[str, ...]:
        return (*STREAM_ORDER, *self.extras, SIDE)

    def _table(self, name: Name, keys: tuple, columns: list[tuple[str, str]]) -> SmallTable:
        keys = tuple(row_column(k, self._keep) for k in keys)
        spec = TableSpec(*name, keys, STREAM_ORDER, self.buckets.get(name, self.default_buckets), self.policy)
        return SmallTable(self._lakes.setdefault(spec, LakeTable(self.spark, self.root, spec)), columns)

    def _fits(self, table: SmallTable) -> bool:
        """Whether a table can share a job: its keys are in the catalog, and its stored columns keep their types."""
        types = {row_column(c, self._keep): t for c, t in table.columns}
        return set(table.lake.spec.keys) <= types.keys() and table.lake.takes(types)

    def _merge_together(self, staged: DataFrame, tables: list[SmallTable], batch_id: int) -> None:
        rows = staged.filter(F.col(_OK) & F.col(_WHERE).isin([".".join(t.name) for t in tables])).drop("table_id")
        path = f"{self.root}/stage/{self.name}/together-{batch_id}-{'.'.join(tables[0].name)}"
        seen = merge_together(self.spark, rows, tables, path, self.extras, self.label, batch_id)
        if seen["lost"] or seen["keyless"]:  # only then are the rows read a second time
            typed = typed_together(rows, tables, self.extras, self.label, batch_id)
            found = typed.groupBy("_slot").agg(F.sum(F.col("_lost")).alias("lost"), F.count_if(null_key()).alias("keyless"))
            for r in found.collect():
                table = tables[r["_slot"]]
                self._lost[table.name] = r["lost"] or 0
                if r["keyless"]:
                    self._quarantine_keyless(_rows_of(staged, table.name), table, batch_id)

    def _merge(self, rows: DataFrame, table: SmallTable, batch_id: int) -> None:
        lake, keys = table.lake, table.lake.spec.keys
        missing = set(keys) - {row_column(c, self._keep) for c, _ in table.columns}
        if missing:
            raise LookupError(f"key columns {sorted(missing)} are not in the catalog")
        typed = typed_events(tag_binlog(rows), table.columns, self.label, self._keep, lost=_LOST, rest=self.rest)
        nulls = Observation()
        typed = typed.observe(nulls, F.count_if(any_null(keys)).alias("n"), F.sum(_LOST).alias("lost")).drop(_LOST)
        lake.merge(as_changes(typed, keys, STREAM_ORDER, batch_id), batch_id)
        self._lost[table.name] = nulls.get["lost"] or 0
        if nulls.get["n"]:
            self._quarantine_keyless(rows, table, batch_id)

    def _quarantine_keyless(self, rows: DataFrame, table: SmallTable, batch_id: int) -> None:
        whole = (*self._event_columns, "values")
        keyed = typed_events(rows, table.columns, self.label, whole)
        names = [row_column(c, whole) for c, _ in table.columns if row_column(c, self._keep) in table.lake.spec.keys]
        self._quarantine(keyed.filter(any_null(names)), "null_key", table.name, batch_id)

    def _settle(self, table: SmallTable) -> None:
        """What follows a merge: compaction where it is due, and the catalog."""
        if len(table.lake.change_folders()) >= self.compact_after:
            table.lake.compact()
        if self.prefix is not None and table.lake.schema is not None:
            self._register(table.lake)

    def _register(self, lake: LakeTable) -> None:
        """The rows are stored by now; a catalog that takes no name or is away is no reason to store them twice."""
        try:
            lake.register(self.prefix)
        except Exception:
            log.exception("%s not registered", lake.root)
            self._unregistered.append((lake.spec.database, lake.spec.table))

    def _quarantine(self, rows: DataFrame, reason: str, name: Name | None, batch_id: int) -> None:
        """The kept text is a whole event again, so it can be sent once more. Without a name the rows are of several tables."""
        row = F.struct(F.from_json("values", VALUES_MAP).alias("values")).alias("row")
        value = F.to_json(F.struct(*self._event_columns, row), {"ignoreNullFields": "false"})
        out = quarantine_rows(rows, F.lit(reason), batch_id, ".".join(name) if name else F.concat_ws(".", "schema", "table"), value, self.name)
        write_quarantine(out, self.quarantine_path)

    def _report(self, good: dict[Name, int], bad: int, failed: dict, batch_id: int) -> None:
        rows = [
            metric_row("tableRecords", n, COUNT, batch_id, {"schema": s, "table": t})
            for (s, t), n in good.items()
        ]
        rows += [metric_row("tableFailed", 1, COUNT, batch_id, {"schema": s, "table": t}) for s, t in failed]
        lost, self._lost = self._lost, {}
        rows += [metric_row("castFailures", n, COUNT, batch_id, {"schema": s, "table": t}) for (s, t), n in lost.items() if n]
        unregistered, self._unregistered = self._unregistered, []
        rows += [metric_row("registerFailed", 1, COUNT, batch_id, {"schema": s, "table": t}) for s, t in unregistered]
        rows.append(metric_row("quarantined", bad, COUNT, batch_id, {}))
        append_metrics(self.spark, rows, self.metrics_path, self.name)


def _write_stage(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*_PARTS).parquet(path)


def _write_direct(rows: DataFrame, path: str) -> None:
    """Without a sort by table: one open file for each, and one for the rejects."""
    conf, name = rows.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, DIRECT_TABLES + 1)
    try:
        _write_stage(rows, path)
    finally:
        conf.set(name, before)


def _rows_of(staged: DataFrame, name: Name) -> DataFrame:
    """One table's rows; the partition is pruned, the names themselves decide."""
    part = F.col(_OK) & (F.col(_WHERE) == ".".join(name))
    return staged.filter(part & (F.col("schema") == name[0]) & (F.col("table") == name[1])).drop("table_id")
