"""Many small tables of one batch: shared jobs give the rows that a job per table gives."""

import json

import pytest
from pyspark.sql import functions as F

from rowtide.plans import together
from rowtide.session import shared_dir
from rowtide.sinks.quarantine import read_quarantine
from rowtide.sinks.table import LakeTable
from rowtide.spec import TableSpec
from rowtide.streaming.apply import ChangeApplier

TYPES = {"id": "bigint", "name": "varchar", "price": "double", "code": "varchar", "log_type": "varchar"}


def event(table, op, time, pos, **values):
    return json.dumps({"schema": "s", "table": table, "log_type": op, "date_action": time, "log_position": pos, "row": {"values": values}})


def applier(spark, root, tables, **how):
    """``tables``: name -> (key columns, columns)."""
    control = spark.createDataFrame([("s", t, k) for t, (k, _) in tables.items()], "database string, table string, table_id string")
    catalog = spark.createDataFrame([("s", t, c, how.get("types", {}).get((t, c), TYPES[c])) for t, (_, cs) in tables.items() for c in cs], "database string, table string, column string, data_type string")
    how.pop("types", None)
    return ChangeApplier(spark, root, lambda: control, lambda: catalog, prefix="together_", **how)


def state(spark, root, tables):
    out = {}
    for t, (k, _) in tables.items():
        keys = tuple(f"row_{x}" if x == "log_type" else x for x in k.split(", "))
        lake = LakeTable(spark, root, TableSpec("s", t, keys))
        if lake.schema is not None:
            out[t] = sorted((sorted((c, str(v)) for c, v in r.asDict().items()) for r in lake.read().collect()), key=str)
            out[t, "schema"] = lake.schema.simpleString()
    return out


TABLES = {f"t{n}": ("id", ["id", "name"]) for n in range(6)} | {
    "two": ("id, code", ["code", "id", "price"]),
    "odd": ("code", ["code", "log_type", "price"]),
    "text": ("id", ["id", "price"]),
    "gone": ("id", ["id", "name"]),
}


def batches(spark):
    first = [event(f"t{n}", "WriteRowsEvent", 1000 + k, k, id=k % 4, name=f"n{n}-{k}") for n in range(6) for k in range(9)]
    first += [event("two", "WriteRowsEvent", 1, k, id=k % 2, code=str(k % 3), price="x" if k == 3 else k / 2) for k in range(8)]
    first += [event("odd", "UpdateRowsEvent", 1, 1, code="c", log_type="inner", price=2.5), event("odd", "UpdateRowsEvent", 1, 1, price=3)]
    first += [event("text", "WriteRowsEvent", 1, 1, id="seven", price=1), event("gone", "DeleteRowsEvent", 5, 1, id=1, name="x")]
    second = [event("t0", "DeleteRowsEvent", 2000, 1, id=1, name="zz"), event("t1", "UpdateRowsEvent", 5, 1, id=0, name="late"), event("t1", "UpdateRowsEvent", 9000, 1, id=0, name=None)]
    second += [event("gone", "WriteRowsEvent", 4, 1, id=1, name="old"), event("gone", "WriteRowsEvent", 6, 1, id=2, name="new"), event("two", "DeleteRowsEvent", 2, 1, id=1, code="1")]
    return [spark.createDataFrame([(x,) for x in texts], "value string") for texts in (first, second)]


@pytest.mark.parametrize("limit", [400, 4])
def test_shared_jobs_give_the_same_tables(spark, monkeypatch, limit):
    monkeypatch.setattr(together.groups, "__defaults__", (limit,))
    types = {("text", "id"): "bigint", ("t5", "name"): "int"}
    got = []
    for rows in (100_000, 0):
        root = shared_dir(spark, "together")
        streams = applier(spark, root, TABLES, together_rows=rows, types=types)
        for n, batch in enumerate(batches(spark)):
            streams(batch, n)
            streams(batch, n)  # a replay
        bad = read_quarantine(spark, streams.quarantine_path).select("reason", "table", "value", "batch_id")
        got.append((state(spark, root, TABLES), sorted(map(tuple, bad.collect()), key=str)))
    assert got[0] == got[1]
    assert {r[:2] for r in got[0][1]} == {("null_key", "odd"), ("null_key", "text")}


def test_new_columns_and_changed_types(spark):
    root = shared_dir(spark, "together")
    tables = {t: TABLES[t] for t in ("t0", "t1")}
    applier(spark, root, tables)(batches(spark)[0], 0)
    wider = {t: ("id", ["id", "name", "price"]) for t in tables}
    stream = applier(spark, root, wider, types={("t1", "name"): "bigint"})
    text = [event(t, "UpdateRowsEvent", 9_000_000, 1, id=0, name="5", price=1.5) for t in tables]
    stream(spark.createDataFrame([(x,) for x in text], "value string"), 1)
    for t, name in (("t0", "5"), ("t1", 5)):
        rows = {r.id: (r["name"], r.price) for r in LakeTable(spark, root, TableSpec("s", t, ("id",))).read().collect()}
        assert rows[0] == (name, 1.5) and len(rows) == 4 and rows[1][1] is None


def jobs_of(spark, work):
    group = shared_dir(spark, "group")
    spark.sparkContext.setJobGroup(group, "count")
    try:
        work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_the_number_of_jobs_does_not_grow_with_the_tables(spark):
    seen = []
    for n in (5, 40):
        tables = {f"t{k}": ("id", ["id", "name"]) for k in range(n)}
        stream = applier(spark, shared_dir(spark, "together"), tables)
        text = [event(t, "WriteRowsEvent", 1, k, id=k, name="x") for t in tables for k in range(3)]
        batch = spark.createDataFrame([(x,) for x in text], "value string")
        stream(batch, 0)
        seen.append(jobs_of(spark, lambda: stream(batch, 1)))
    assert seen[1] <= seen[0] + 2, seen


def test_one_bad_table_does_not_stop_the_others(spark, monkeypatch):
    root = shared_dir(spark, "together")
    tables = {t: TABLES[t] for t in ("t0", "t1", "t2")}
    stream = applier(spark, root, tables, on_error="quarantine")
    real = LakeTable.adopt

    def broken(self, *args):
        if self.spec.table == "t1":
            raise OSError("no space")
        return real(self, *args)

    monkeypatch.setattr(LakeTable, "adopt", broken)
    merge = LakeTable.merge
    monkeypatch.setattr(LakeTable, "merge", lambda self, *args: broken(self, *args) if self.spec.table == "t1" else merge(self, *args))
    stream(batches(spark)[0], 0)
    assert LakeTable(spark, root, TableSpec("s", "t0", ("id",))).read().count() == 4
    assert LakeTable(spark, root, TableSpec("s", "t2", ("id",))).read().count() == 4
    bad = read_quarantine(spark, stream.quarantine_path).groupBy("reason", "table").agg(F.count("*").alias("n")).collect()
    assert ("write_failed: OSError", "t1", 9) in {tuple(r) for r in bad}
