"""Control table, daily files, catalog reads, the batch job."""

import datetime as dt
import json
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from rowtide import shared_dir
from rowtide.plans.batch import BatchJob, apply_day, control_table, put_control, run_batch, run_days
from rowtide.plans.tables import for_each
from rowtide.schemas import CONTROL
from rowtide.sinks.quarantine import read_quarantine
from rowtide.sinks.table import LakeTable
from rowtide.sources import catalog as cat
from rowtide.sources import control as ct
from rowtide.sources.files import read_changes_for_day, write_changes_by_day

DAY = dt.date(2024, 3, 5)


def test_control_json_due_and_advance(spark):
    path = shared_dir(spark, "c")
    items = [
        {"database": "d", "table": "a", "table_id": "id", "last_date": "2023-12-31", "first_load": True},
        {"database": "d", "table": "b", "table_id": "id", "last_date": "2024-02-28", "first_load": False, "is_stream": True},
    ]
    spark.createDataFrame([(json.dumps(i),) for i in items], "value string").write.text(path)
    control = ct.read_control(spark, path)
    assert {r.table: r.load_date for r in ct.due(control).collect()} == {"a": dt.date(2024, 1, 1), "b": dt.date(2024, 2, 29)}
    assert [r.table for r in ct.due(control, True).collect()] == ["a"]
    assert [r.table for r in ct.due(control, False).collect()] == ["b"]
    moved = ct.advance(control)
    assert moved.columns == [f.name for f in CONTROL]
    assert {(r.last_date, r.first_load, r.is_stream) for r in moved.collect()} == {(dt.date(2024, 1, 1), False, False), (dt.date(2024, 2, 29), False, False)}


def test_put_replaces_the_whole_row_of_its_key(spark):
    control = control_table(spark, shared_dir(spark, "c"))
    row = ("d", "a", "id", DAY, True, True)
    put_control(control, spark.createDataFrame([row, ("d", "b", "id", DAY, True, False)], CONTROL))
    put_control(control, spark.createDataFrame([("d", "a", "k", dt.date(2020, 1, 1), False, None)], CONTROL))
    got = {r.table: tuple(r[c] for c in ("table_id", "last_date", "first_load", "is_stream")) for r in control.read().collect()}
    assert got == {"a": ("k", dt.date(2020, 1, 1), False, None), "b": ("id", DAY, True, False)}


def test_daily_scan_opens_the_day_only(spark):
    root = shared_dir(spark, "d")
    rows = spark.createDataFrame([(n, dt.date(2024, 3, n)) for n in range(1, 10)], "id int, d date")
    write_changes_by_day(rows, root, "db", "t", "d")
    day = read_changes_for_day(spark, root, "db", "t", DAY)
    assert [r.id for r in day.collect()] == [5]
    assert len(day.inputFiles()) == 1 and "/day=5/" in day.inputFiles()[0]
    spark.range(3).write.parquet(f"{root}/db/plain/2024/03/05")
    assert read_changes_for_day(spark, root, "db", "plain", DAY, layout="plain").count() == 3


def test_catalog_read_pushes_names_as_predicates(spark, monkeypatch):
    seen = {}
    rows = [("d", "t", "id", "int", 10, 0), ("other", "t", "id", "int", 10, 0), ("x' or '1'='1", "t", "id", "int", 10, 0)]
    names = ", ".join(f"{c} {'int' if c.startswith('NUMERIC') else 'string'}" for c in cat.COLUMNS)

    def jdbc(self, url, table, properties):
        seen.update(url=url, table=table, properties=properties)
        return spark.createDataFrame(rows, names)

    monkeypatch.setattr("pyspark.sql.DataFrameReader.jdbc", jdbc)
    got = cat.read_catalog(spark, "jdbc:x", ["d", "x' or '1'='1"], {"user": "u"})
    assert {r["database"] for r in got.collect()} == {"d", "x' or '1'='1"}
    assert got.columns == list(cat.COLUMNS.values())
    assert seen == {"url": "jdbc:x", "table": "INFORMATION_SCHEMA.COLUMNS", "properties": {"user": "u"}}


def test_key_lookup_and_registered_only(spark):
    control = spark.createDataFrame([("d", "a", "id", None, None, None)], CONTROL)
    rows = spark.createDataFrame([("d", "a", 1), ("d", "zz", 2), (None, "a", 3)], "schema string, table string, n int")
    assert {r.n: r.table_id for r in ct.key_lookup(rows, control).collect()} == {1: "id", 2: None, 3: None}
    assert [r.n for r in ct.registered_only(rows, control).collect()] == [1]


def job_world(spark):
    root = shared_dir(spark, "job")
    spark.createDataFrame([("1", "10.5", None), ("2", "x", "note"), ("no number", "1", "")], "id string, price string, note string").write.parquet(f"{root}/snap/d/fresh")
    changes = [(1, "7", "c", DAY, 1), (2, "8", "u", DAY, 2), (2, None, "d", DAY, 3), (3, "9", "r", DAY, 4), (None, "9", "u", DAY, 5), (9, "9", "u", dt.date(2024, 3, 6), 6)]
    frame = spark.createDataFrame(changes, "id int, price string, __op string, day date, __source_pos long")
    write_changes_by_day(frame.withColumn("__source_ts_ms", F.lit("1709596800000")), f"{root}/changes", "d", "old", "day")
    control = control_table(spark, root)
    before = DAY - dt.timedelta(days=1)
    put_control(control, spark.createDataFrame([("d", "fresh", "id", before, True, False), ("d", "old", "id", before, False, True), ("d", "lost", "id", before, True, False)], CONTROL))
    columns = [(t, c, k) for t in ("fresh", "old") for c, k in (("id", "int"), ("price", "decimal"))]
    catalog = spark.createDataFrame([("d", t, c, k) for t, c, k in columns], "database string, table string, column string, data_type string")
    job = BatchJob(f"{root}/lake", f"{root}/snap/{{database}}/{{table}}", f"{root}/changes", default_buckets=2, prefix="jobtest_")
    return job, control, catalog


def test_batch_job(spark):
    job, control, catalog = job_world(spark)
    outcome = run_batch(spark, job, control, catalog)
    assert [(name, type(e)) for name, e in outcome.failed] == [(("d", "lost"), LookupError)] and outcome.absent == []
    fresh = {r.id: r.asDict() for r in LakeTable(spark, job.root, job.spec("d", "fresh", "id")).read().collect()}
    assert fresh[1]["price"] == 10.5 and fresh[1]["note"] == "" and fresh[2]["price"] is None
    assert fresh[1]["Action"] == "Hinata" and fresh[1]["__op"] == "s" and fresh[1]["__source_ts_ms"] == 1618790418000
    old = {r.id: r.price for r in LakeTable(spark, job.root, job.spec("d", "old", "id")).read().collect()}
    assert old == {1: 7.0}
    bad = {(r.reason, json.loads(r["value"]).get("__source_pos")) for r in read_quarantine(spark, job.quarantine).collect()}
    assert bad == {("unknown_operation", 4), ("null_key", 5), ("null_key", 0)}
    moved = {r.table: (r.last_date, r.first_load, r.is_stream) for r in control.read().collect()}
    assert moved == {"fresh": (DAY, False, False), "old": (DAY, False, False), "lost": (DAY - dt.timedelta(days=1), True, False)}
    assert spark.table("jobtest_d.fresh").count() == 2


def test_same_day_twice_is_once(spark):
    job, control, catalog = job_world(spark)
    run_batch(spark, job, control, catalog)
    put_control(control, control.read().withColumn("last_date", F.lit(DAY - dt.timedelta(days=1))).filter("table = 'old'"))
    run_batch(spark, job, control, catalog.filter("table = 'old'"))
    assert {r.id for r in LakeTable(spark, job.root, job.spec("d", "old", "id")).read().collect()} == {1}


def test_days_without_applicable_rows(spark):
    job, control, catalog = job_world(spark)
    spec, columns = job.spec("d", "old", "id"), [("id", "bigint"), ("price", "double")]
    rejected = spark.createDataFrame([(3, "9", "r", dt.date(2024, 4, 1), 4, "1")], "id int, price string, __op string, day date, __source_pos long, __source_ts_ms string")
    write_changes_by_day(rejected, f"{job.root}/other", "d", "old", "day")
    other = replace(job, changes=f"{job.root}/other")
    apply_day(spark, other, spec, columns, dt.date(2024, 4, 1))
    with pytest.raises(FileNotFoundError):
        apply_day(spark, other, spec, columns, dt.date(2024, 4, 2))
    assert [r.reason for r in read_quarantine(spark, job.quarantine).collect()] == ["unknown_operation"]


def day_file(spark, job, day, rows, schema):
    path = f"{job.changes}/d/old/year={day.year}/month={day.month:02d}/day={day.day:02d}"
    spark.createDataFrame(rows, schema).write.parquet(path)


def test_a_late_day_is_waited_for_and_a_new_column_arrives(spark):
    job, control, catalog = job_world(spark)
    catalog = catalog.filter("table = 'old'").unionByName(spark.createDataFrame([("d", "old", "extra", "varchar")], catalog.schema))
    put_control(control, control.read().filter("table = 'old'").withColumn("first_load", F.lit(False)))
    days = [dt.date(2024, 3, 6) + dt.timedelta(days=n) for n in range(3)]  # the first one is there
    schema = "id int, price string, __op string, __source_pos long, __source_ts_ms string, extra string"
    outcome = run_days(spark, job, control, catalog)
    assert ("d", "old") in outcome.absent
    last = {r.table: r.last_date for r in control.read().collect()}
    assert last["old"] == days[0]
    day_file(spark, job, days[2], [(7, "7", "c", 1, "1709769600000", "far")], schema)
    assert run_days(spark, job, control, catalog).done == []
    assert {r.table: r.last_date for r in control.read().collect()}["old"] == days[0]
    day_file(spark, job, days[1], [(1, "11", "u", 1, "1709683200000", "new")], schema)
    run_days(spark, job, control, catalog)
    assert {r.table: r.last_date for r in control.read().collect()}["old"] == days[2]
    got = {r.id: (r.price, r.extra) for r in LakeTable(spark, job.root, job.spec("d", "old", "id")).read().collect()}
    assert got[1] == (11.0, "new") and got[7] == (7.0, "far")


def test_threads_keep_every_error(spark):
    def work(n):
        if n % 2:
            raise ValueError(n)
        return spark.range(n).count()

    got = for_each(spark, range(6), work, parallel=3)
    assert [(i, r, str(e) if e else None) for i, r, e in got] == [(0, 0, None), (1, None, "1"), (2, 2, None), (3, None, "3"), (4, 4, None), (5, None, "5")]


def session_stub(named, master):
    conf = SimpleNamespace(get=lambda key, default=None: named)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(getConf=lambda: conf, master=master))


def test_shared_dir_is_the_one_the_session_names():
    assert shared_dir(session_stub("hdfs:///ck/", "yarn"), "x").startswith("hdfs:///ck/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session_stub(None, "yarn"), "x")
    first, second = (shared_dir(session_stub(None, "local[2]"), "x") for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]
