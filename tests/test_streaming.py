"""Streaming: replay, equivalence, routing of bad rows, failures, metrics."""

import datetime as dt
import json
from types import SimpleNamespace

import pytest

from rowtide import files
from rowtide.schemas import METRIC
from rowtide.session import shared_dir
from rowtide.sinks import metrics as m
from rowtide.sinks.quarantine import read_quarantine
from rowtide.sinks.table import LakeTable
from rowtide.sources.events import event_stream, shard_union, splits, spread
from rowtide.spec import ARRIVAL, EVENT_ORDER, TableSpec
from rowtide.streaming.apply import ChangeApplier
from rowtide.streaming.job import run_available, start_stream
from rowtide.streaming.metrics import BatchMetricsListener
from tests.test_operators import event

CONTROL = [("s", "a", "id"), ("s", "b", "x, y"), ("s", "nocat", "id"), ("s", "badkey", "missing")]
CATALOG = [("s", "a", "id", "int"), ("s", "a", "v", "varchar"), ("s", "b", "x", "int"), ("s", "b", "y", "char"), ("s", "badkey", "id", "int")]


def applier(spark, root=None, **kw):
    control = spark.createDataFrame(CONTROL, "database string, table string, table_id string")
    catalog = spark.createDataFrame(CATALOG, "database string, table string, column string, data_type string")
    return ChangeApplier(spark, root or shared_dir(spark, "s"), lambda: control, lambda: catalog, default_buckets=2, **kw)


def frame(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def rows(app, table="a", keys=("id",)):
    return LakeTable(app.spark, app.root, TableSpec("s", table, keys)).read()


def values(app):
    return {r.id: r.v for r in rows(app).collect()}


def test_mixed_batch_goes_where_it_belongs(spark):
    app = applier(spark, prefix="mixed_", on_error="quarantine")
    app(
        frame(
            spark,
            event("a", schema="s", id=1, v="one"),
            event("a", schema="s", id="2", v="two", position=2),
            event("a", schema="s", op="DeleteRowsEvent", time="2024-01-02", id=2),
            event("a", schema="s", id=None, v="keyless"),
            event("b", schema="s", x=1, y="k"),
            event("nocat", schema="s", id=1),
            event("unknown", schema="s", id=1),
            event("badkey", schema="s", id=1),
            '{"a":1',
            event("a", schema="s", op=None, id=9),
        ),
        0,
    )
    assert values(app) == {1: "one"}
    assert {(r.x, r.y) for r in rows(app, "b", ("x", "y")).collect()} == {(1, "k")}
    bad = {(r.reason, r.table, r.origin) for r in read_quarantine(spark, app.quarantine_path).collect()}
    assert bad == {
        ("null_key", "a", "s.a"),
        ("no_catalog", "nocat", "s.nocat"),
        ("no_key", "unknown", "parse"),
        ("write_failed: LookupError", "badkey", "s.badkey"),
        ("malformed_json", None, "parse"),
        ("no_operation", "a", "parse"),
    }
    assert {r.id for r in spark.table("mixed_s.a").collect()} == {1}
    counts = {(r["dimensions"].get("table"), r["name"]): r["value"] for r in m.read_metrics(spark, app.metrics_path).collect()}
    assert counts[("a", "tableRecords")] == 4 and counts[(None, "quarantined")] == 3


def test_quarantined_text_can_be_sent_again(spark):
    app = applier(spark)
    app(frame(spark, event("unknown", schema="s", id=1, v="x")), 0)
    text = read_quarantine(spark, app.quarantine_path).first()["value"]
    fixed = json.loads(text) | {"table": "a"}
    app(frame(spark, json.dumps(fixed)), 1)
    assert values(app) == {1: "x"}


def test_a_replayed_batch_changes_nothing(spark):
    for policy in (EVENT_ORDER, ARRIVAL):
        app = applier(spark, policy=policy)
        batch = frame(spark, event("a", id=1, v="x"), event("a", op="DeleteRowsEvent", id=2), event("a", id=2, v="y", position=2), event("zzz", id=0))
        app(batch, 0)
        once = values(app), read_quarantine(spark, app.quarantine_path).count()
        app(batch, 0)
        assert (values(app), read_quarantine(spark, app.quarantine_path).count()) == once
        assert once[0] == ({1: "x", 2: "y"} if policy == EVENT_ORDER else {1: "x"})


def test_two_streams_share_the_tables(spark):
    batch = frame(spark, event("a", id=1, v="x"), event("b", x=1, y="k"), "broken", event(None, id=1))
    slow = applier(spark, only=frozenset({("s", "b")}), name="slow")
    quick = applier(spark, slow.root, skip=slow.only)
    slow(batch, 0)
    assert not files.exists(spark, slow.quarantine_path)
    quick(batch, 0)
    assert values(quick) == {1: "x"} and rows(slow, "b", ("x", "y")).count() == 1
    assert {r.reason for r in read_quarantine(spark, quick.quarantine_path).collect()} == {"malformed_json", "no_table"}


def test_values_that_are_no_object_and_awkward_columns(spark):
    control = spark.createDataFrame([("s", "odd", "date_action")], "database string, table string, table_id string")
    columns = [("date_action", "int"), ("table", "varchar"), ("Id", "varchar"), ("id", "varchar"), ("doc", "json"), ("_batch", "int")]
    catalog = spark.createDataFrame([("s", "odd", c, t) for c, t in columns], "database string, table string, column string, data_type string")
    app = ChangeApplier(spark, shared_dir(spark, "s"), lambda: control, lambda: catalog, default_buckets=2, prefix="odd_")
    good = event("odd", more={"date_action": 5, "table": "t", "Id": "I", "id": "i", "doc": {"a": [1, None]}, "_batch": 3, "unlisted": 1})
    keyless = event("odd", more={"date_action": None, "id": "k"})
    broken = json.dumps(json.loads(good) | {"row": {"values": 5}})
    app(frame(spark, good, keyless, broken), 0)
    row = LakeTable(spark, app.root, TableSpec("s", "odd", ("row_date_action",))).read().first().asDict()
    assert (row["row_date_action"], row["table"], row["Id"], row["id"], row["row__batch"]) == (5, "t", "I", "i", 3)
    assert json.loads(row["doc"]) == {"a": [1, None]} and row["date_action"].year == 2024
    bad = {r.reason: r.value for r in read_quarantine(spark, app.quarantine_path).collect()}
    assert set(bad) == {"null_key", "malformed_json"}
    assert json.loads(bad["null_key"])["row"]["values"] == {"date_action": None, "id": "k"}


def test_batch_of_keyless_rows_only(spark):
    app = applier(spark)
    app(frame(spark, event("a", id=None), event("a", id="x", op="DeleteRowsEvent")), 0)
    assert [r.reason for r in read_quarantine(spark, app.quarantine_path).collect()] == ["null_key", "null_key"]
    assert LakeTable(spark, app.root, TableSpec("s", "a", ("id",))).schema is None


def test_further_event_fields_are_kept(spark, caplog):
    app = applier(spark, extras=("server", "gtid"))
    text = json.dumps(json.loads(event("a", id=1, v="x")) | {"server": 7, "unused": 1})
    with caplog.at_level("DEBUG", logger="rowtide.streaming.apply"):
        app(frame(spark, text, event("zzz", id=1)), 0)
    row = rows(app).first()
    assert (row.id, row.server, row.gtid) == (1, "7", None)
    assert "batch 0: 2 rows of 1 tables" in caplog.text and "starts with" in caplog.text
    kept = json.loads(read_quarantine(spark, app.quarantine_path).first()["value"])
    assert kept == json.loads(event("zzz", id=1))


def test_no_event_stops_the_stream(spark):
    app = applier(spark)
    odd = [event("", id=1), json.dumps(json.loads(event("a", id=1)) | {"schema": ""}), event("a/../b", id=1), event("a", id=1) + "x", "", "[]", "null"]
    app(frame(spark, event("a", id=1, v="x"), *odd), 0)
    assert values(app) == {1: "x"}
    assert {"no_table", "no_key", "malformed_json"} <= {r.reason for r in read_quarantine(spark, app.quarantine_path).collect()}


def test_unknown_tables_are_one_write(spark):
    app = applier(spark)
    app(frame(spark, event("a", id=1, v="x"), *[event(f"t{n}", id=n) for n in range(60)]), 0)
    bad = read_quarantine(spark, app.quarantine_path)
    assert {(r.reason, r.origin, r.writer) for r in bad.collect()} == {("no_key", "parse", "changes")} and bad.count() == 60


def test_streams_of_one_root_keep_their_rejects_apart(spark):
    main = applier(spark, name="main", skip=frozenset({("s", "b")}))
    side = applier(spark, main.root, name="side", only=frozenset({("s", "b")}))
    batch = frame(spark, "broken", event(None, id=1), event("b", op=None, x=1, y="k"))
    main(batch, 0)
    side(batch, 0)
    bad = {(r.writer, r.reason) for r in read_quarantine(spark, main.quarantine_path).collect()}
    assert bad == {("main", "malformed_json"), ("main", "no_table"), ("side", "no_operation")}


def test_a_failed_registration_does_not_quarantine_stored_rows(spark, monkeypatch):
    def refuse(self, prefix):
        raise RuntimeError("no catalog")

    monkeypatch.setattr(LakeTable, "register", refuse)
    app = applier(spark)
    app(frame(spark, event("a", id=1, v="x")), 0)
    assert values(app) == {1: "x"} and not files.exists(spark, app.quarantine_path)
    assert "registerFailed" in {r["name"] for r in m.read_metrics(spark, app.metrics_path).collect()}


def test_changes_are_folded_in_from_time_to_time(spark):
    app = applier(spark, compact_after=3)
    for n in range(8):
        app(frame(spark, event("a", id=n % 3, v=f"v{n}", position=n)), n)
        assert len(LakeTable(spark, app.root, TableSpec("s", "a", ("id",))).change_folders()) < 3
    assert values(app) == {0: "v6", 1: "v7", 2: "v5"}


def test_ended_query_reports_an_error_metric(spark):
    path = shared_dir(spark, "m")
    listener = BatchMetricsListener(spark, path, "app", "j")
    listener.onQueryTerminated(SimpleNamespace(exception=None, runId=None))
    listener.onQueryTerminated(SimpleNamespace(exception="boom", runId=None))
    got = m.read_metrics(spark, path).collect()
    assert [(r["name"], r["value"], r["dimensions"]) for r in got] == [("receiverError", 1.0, {"ApplicationName": "app", "JobFlowId": "j"})]


def test_empty_batch_is_skipped(spark):
    app = applier(spark)
    app(frame(spark).limit(0), 0)
    assert LakeTable(spark, app.root, TableSpec("s", "a", ("id",))).schema is None


def test_failing_table_can_fail_the_batch(spark):
    app = applier(spark, on_error="fail")
    with pytest.raises(RuntimeError, match="badkey"):
        app(frame(spark, event("badkey", id=1), event("a", id=1, v="x")), 0)
    assert values(app) == {1: "x"}


def write_files(spark, path, batches):
    for n, texts in enumerate(batches):
        frame(spark, *texts).coalesce(1).write.mode("append").text(path)


@pytest.mark.parametrize("per_trigger", ["1", "5", "30"])
def test_stream_equals_one_batch(spark, per_trigger):
    batches = [
        [event("a", id=n % 3, v=f"v{n}", time=f"2024-01-{n + 1:02d}", op="DeleteRowsEvent" if n % 4 == 3 else "UpdateRowsEvent", position=n)]
        for n in range(6)
    ]
    root = shared_dir(spark, "in")
    write_files(spark, f"{root}/in", batches)
    whole = applier(spark)
    whole(frame(spark, *[t for b in batches for t in b]), 0)
    app = applier(spark, f"{root}/lake")
    source = event_stream(spark, "text", path=f"{root}/in", maxFilesPerTrigger=per_trigger)
    run_available(source, app, f"{root}/checkpoint")
    assert values(app) == values(whole) == {1: "v4", 2: "v5"}
    # a restart has nothing left to do, and new files go on from there
    write_files(spark, f"{root}/in", [[event("a", id=50, v="more", time="2024-02-01")]])
    run_available(source, applier(spark, f"{root}/lake"), f"{root}/checkpoint")
    assert values(app) == values(whole) | {50: "more"}


def test_listener_writes_one_set_of_metrics_per_batch(spark):
    root = shared_dir(spark, "m")
    write_files(spark, f"{root}/in", [[event("a", id=1, v="x"), event("a", id=2, v="y")], [event("a", id=3, v="z")]])
    app = applier(spark, f"{root}/lake")
    query, listener = start_stream(event_stream(spark, "text", path=f"{root}/in", maxFilesPerTrigger="1"), app, f"{root}/c", None, "counted", "j-1")
    query.awaitTermination()
    assert listener.ended.wait(30)
    got = m.batch_metrics(m.read_metrics(spark, app.metrics_path)).filter("numRecords is not null").collect()
    spark.streams.removeListener(listener)
    assert {(r.batch_id, r.numRecords) for r in got} in ({(0, 2.0), (1, 1.0)}, {(0, 1.0), (1, 2.0)})
    assert all(r.totalDelay == r.processingDelay + r.schedulingDelay for r in got)
    names = {r["name"] for r in m.read_metrics(spark, app.metrics_path).filter("dimensions['JobFlowId'] = 'j-1'").collect()}
    assert names == {"batchCompleted", "schedulingDelay", "processingDelay", "numRecords", "totalDelay"}


def test_scheduling_delay_is_the_overrun_of_the_tick(spark):
    listener = BatchMetricsListener(spark, "unused", "app", "", 100)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    listener.rows(0, start, 1, 130_000)
    later = {r[0]: r[1] for r in listener.rows(1, start + dt.timedelta(seconds=130), 1, 5)}
    assert later["schedulingDelay"] == 30_000 and later["totalDelay"] == 30_005


def test_last_report_of_a_replayed_batch_counts(spark):
    at = [dt.datetime(2024, 1, d, tzinfo=dt.timezone.utc) for d in (1, 2)]
    rows = [m.metric_row("numRecords", n, m.COUNT, 7, {}, t) for n, t in zip((5, 6), at)]
    got = m.batch_metrics(spark.createDataFrame(rows, METRIC)).collect()
    assert [(r.batch_id, r.numRecords, r.totalDelay) for r in got] == [(7, 6.0, None)]


def test_shards_are_united_by_name(spark):
    a, b = spark.sql("select 1 x, 2 y"), spark.sql("select 3 y, 4 x")
    assert {tuple(r) for r in shard_union([a, b]).select("x", "y").collect()} == {(1, 2), (4, 3)}


def _plans(spark, app, batch, path, monkeypatch):
    """Exchanges of the plan that ``stage`` writes."""
    from rowtide.streaming import apply

    seen = []
    monkeypatch.setattr(apply, "_write_stage", lambda rows, path: seen.append(rows._jdf.queryExecution().executedPlan().toString()))
    app.stage(batch, path)
    return seen[0]


def test_control_rows_made_from_a_large_table_move_no_events(spark, monkeypatch):
    """By the estimate of its source the control table is too large for a broadcast; the rows themselves are few."""
    folder = shared_dir(spark, "big")
    spark.range(20_000).selectExpr("'s' as database", "'a' as table", "'id' as table_id", "sha2(string(id), 256) as more").write.parquet(folder)
    app = applier(spark, prefix=None)
    app.control = lambda: spark.read.parquet(folder).select("database", "table", "table_id").distinct()
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4k")
    try:
        plan = _plans(spark, app, frame(spark, event("a", schema="s", id=1, v="one")), f"{app.root}/st", monkeypatch)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_rows_in_many_splits_are_not_dealt_again(spark, monkeypatch):
    batch = frame(spark, *[event("a", schema="s", id=k, v=f"v{k}") for k in range(40)], '{"a":1')
    dealt = batch.repartition(6).select("value")
    assert splits(dealt) == 6 and splits(dealt.union(dealt)) == 12 and splits(dealt.coalesce(1)) == 1
    assert spread(dealt, 6) is dealt and splits(spread(dealt, 7)) == 7
    app = applier(spark, prefix=None, parse_tasks=6)
    with monkeypatch.context() as m:
        plan = _plans(spark, app, dealt, f"{app.root}/st", m)
        assert plan.count("Exchange") == 1 + plan.count("BroadcastExchange") and "Sort " not in plan
    app(dealt, 0)
    assert values(app) == {k: f"v{k}" for k in range(40)}
    assert [r.reason for r in read_quarantine(spark, app.quarantine_path).collect()] == ["malformed_json"]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
