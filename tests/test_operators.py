"""Operators on small literal frames: the edge cases of the semantics."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from rowtide.functions.casting import MYSQL_TYPES, TypeRules, safe_cast
from rowtide.functions.dates import add_days_text, day_parts
from rowtide.operators import events as ev
from rowtide.operators import latest as lt
from rowtide.operators import merge as mg
from rowtide.operators import typed as ty
from rowtide.spec import ARRIVAL, EVENT_ORDER, TableSpec, buckets_for, split_keys


def event(table="t", op="UpdateRowsEvent", time="2024-01-01 00:00:00", position=1, schema="s", more=None, **values):
    body = {"schema": schema, "table": table, "log_type": op, "date_action": time, "log_position": position}
    return json.dumps({**body, "row": {"values": {**values, **(more or {})}}})


def parse(spark, *texts):
    return ev.parse_events(spark.createDataFrame([(t,) for t in texts], "value string"))


def reasons(frame):
    return {r["value"]: r[ev.REASON] for r in frame.select("value", ev.REASON).collect()}


# ---- parse


def test_malformed_text_is_kept_with_its_reason(spark):
    got = reasons(parse(spark, '{"a":1', "[]", "x", event(id=1)))
    assert got == {'{"a":1': "malformed_json", "[]": "malformed_json", "x": "malformed_json", event(id=1): None}


def test_null_text_is_malformed(spark):
    assert parse(spark, None).first()[ev.REASON] == "malformed_json"


def test_array_text_gives_one_row_per_event(spark):
    text = f"[{event(id=1)},{event(id=2)},{{\"schema\": 5]"
    good = parse(spark, f"[{event(id=1)}, {event(id=2)}]")
    assert sorted(r["values"]["id"] for r in ev.accepted(good).collect()) == ["1", "2"]
    assert reasons(parse(spark, text)) == {text: "malformed_json"}


def test_bytes_are_decoded(spark):
    raw = spark.createDataFrame([(bytearray(event(name="é").encode()),)], "value binary")
    assert ev.parse_events(raw).first()["values"]["name"] == "é"


def test_missing_parts_have_reasons(spark):
    cases = {
        '{"schema":"s","log_type":"x","row":{"values":{}}}': "no_table",
        '{"table":"t","log_type":"x","row":{"values":{}}}': "no_table",
        '{"schema":"s","table":"t","row":{"values":{}}}': "no_operation",
        '{"schema":"s","table":"t","log_type":"x"}': "no_values",
    }
    assert reasons(parse(spark, *cases)) == cases


def test_same_column_keeps_its_own_type_per_table(spark):
    frame = parse(spark, event("a", id=7), event("b", id="seven"))
    assert {r["table"]: r["values"]["id"] for r in frame.collect()} == {"a": "7", "b": "seven"}


def test_absent_and_null_values_differ_only_in_the_map(spark):
    frame = parse(spark, event(id=1, note=None), event(id=2))
    got = frame.select(
        F.col("values")["id"].alias("id"), F.map_contains_key("values", F.lit("note")).alias("has"), F.col("values")["note"].alias("note")
    ).collect()
    assert {(r.id, r.has, r.note) for r in got} == {("1", True, None), ("2", False, None)}


def test_event_time_as_text_or_number(spark):
    text, ms, s, us = "2021-04-19 00:00:18", 1618790418000, 1618790418, 1618790418000000

    def read(unit, *forms):
        got = ev.parse_events(spark.createDataFrame([(event(time=f),) for f in forms], "value string"), time_unit=unit)
        return [(r["date_action"], r["_reason"]) for r in got.select(F.col("date_action").cast("string"), "_reason").collect()]

    assert read("ms", text, ms) == read("s", text, s) == read("us", text, us) == [(text, None)] * 2
    assert read("text", text, ms, "soon") == [(text, None), (None, "bad_time"), (None, "bad_time")]
    # the size of a number decides nothing
    assert read("ms", 86_400_000, 0) == [("1970-01-02 00:00:00", None), ("1970-01-01 00:00:00", None)]
    assert read("s", 99_999_999_999)[0][0].startswith("5138") and read("us", 12345)[0][0].startswith("1970-01-01")
    with pytest.raises(ValueError, match="time unit"):
        read("minutes", text)


# ---- split


def test_binlog_split_sends_null_operation_to_neither_side(spark):
    rows = spark.createDataFrame([("DeleteRowsEvent",), ("WriteRowsEvent",), ("odd",), (None,)], "log_type string")
    up, gone, bad = ev.split_ops(ev.tag_binlog(rows))
    assert sorted(r[0] for r in up.collect()) == ["WriteRowsEvent", "odd"]
    assert [r[0] for r in gone.collect()] == ["DeleteRowsEvent"]
    assert [r[0] for r in bad.collect()] == [None]


def test_debezium_split_takes_listed_operations_only(spark):
    rows = spark.createDataFrame([(o,) for o in ("c", "u", "d", "r", None)], "__op string")
    up, gone, bad = ev.split_ops(ev.tag_debezium(rows))
    assert (up.count(), gone.count(), bad.count()) == (2, 1, 2)
    assert ev.split_ops(ev.tag_debezium(rows, upserts=("c", "u", "r")))[0].count() == 3


# ---- types


def test_every_type_has_a_rule_or_falls_back_to_text(spark):
    names = [*MYSQL_TYPES, "longblob", "year", "geometry"]
    catalog = spark.createDataFrame([("s", "t", f"c{i}", n) for i, n in enumerate(names)], "database string, table string, column string, data_type string")
    got = {r["data_type"]: (r["spark_type"], r["known"]) for r in ty.catalog_types(catalog).collect()}
    assert len(MYSQL_TYPES) == 24
    assert all(got[n] == (t, True) for n, t in MYSQL_TYPES.items())
    assert all(got[n] == ("string", False) for n in ("longblob", "year", "geometry"))
    assert {r["data_type"] for r in ty.unknown_types(ty.catalog_types(catalog)).collect()} == {"longblob", "year", "geometry"}


def test_exact_decimal_needs_precision(spark):
    rows = [("s", "t", "a", "decimal", 10, 2), ("s", "t", "b", "decimal", None, None), ("s", "t", "c", "decimal", 65, 30)]
    catalog = spark.createDataFrame(rows, "database string, table string, column string, data_type string, precision int, scale int")
    got = {r["column"]: r["spark_type"] for r in ty.catalog_types(catalog, TypeRules(exact_decimal=True)).collect()}
    assert got == {"a": "decimal(10,2)", "b": "double", "c": "double"}


def test_override_by_table_and_by_database(spark):
    rules = TypeRules(overrides={("*", "t", "id"): "string", ("other", "u", "id"): "double"})
    rows = [("s", "t", "id", "int"), ("s", "u", "id", "int"), ("other", "u", "id", "int")]
    catalog = spark.createDataFrame(rows, "database string, table string, column string, data_type string")
    got = {(r["database"], r["table"]): r["spark_type"] for r in ty.catalog_types(catalog, rules).collect()}
    assert got == {("s", "t"): "string", ("s", "u"): "bigint", ("other", "u"): "double"}


@pytest.mark.parametrize(
    "text, target, expected",
    [
        ("x", "bigint", None),
        ("12.7", "bigint", 12),
        ("-12.7", "bigint", -12),
        ("9007199254740993", "bigint", 9007199254740993),
        ("9007199254740993.9", "bigint", 9007199254740993),
        ("1.0E10", "bigint", 10**10),
        ("99999999999999999999", "bigint", None),
        ("true", "bigint", 1),
        ("", "bigint", None),
        ("x", "double", None),
        ("1.1", "double", 1.1),
        ("0000-00-00", "date", None),
        ("2021-13-01", "date", None),
        ("2021-01-02", "date", dt.date(2021, 1, 2)),
        ("2021-01-02 03:04:05", "timestamp_ntz", dt.datetime(2021, 1, 2, 3, 4, 5)),
    ],
)
def test_bad_values_become_null(spark, text, target, expected):
    frame = spark.createDataFrame([(text,)], "c string")
    assert frame.select(safe_cast(F.col("c"), target).alias("v")).first().v == expected


def test_typed_events_survive_awkward_column_names(spark):
    frame = parse(spark, event(id="5", more={"table": "inner", "row": "r", "Id": "upper", "date_action": "2020-01-01", "_bucket": "9"}))
    columns = [("id", "bigint"), ("table", "string"), ("row", "string"), ("Id", "string"), ("absent", "double"), ("date_action", "date"), ("_bucket", "bigint")]
    row = ty.typed_events(frame, columns).first().asDict()
    assert row["id"] == 5 and row["Id"] == "upper" and row["table"] == "inner" and row["row"] == "r"
    assert row["absent"] is None and row["Action"] == "Streaming" and row["row__bucket"] == 9
    assert row["row_date_action"] == dt.date(2020, 1, 1) and row["date_action"].year == 2024


def test_typed_columns_keep_extra_and_add_missing(spark):
    rows = spark.createDataFrame([("1", 2.9, "z")], "id string, n double, extra string")
    got = ty.typed_columns(rows, [("id", "bigint"), ("n", "bigint"), ("late", "date")], "Batch").first().asDict()
    assert got == {"id": 1, "n": 2, "extra": "z", "late": None, "Action": "Batch"}


def test_cast_failures_count_values_lost(spark):
    frame = parse(spark, event(id="1", n="x"), event(id="y", n=None))
    got = {r["column"]: r["n_failed"] for r in ty.cast_failures(frame, [("id", "bigint"), ("n", "bigint")]).collect()}
    assert got == {"id": 1, "n": 1}


def test_null_fill_by_type(spark):
    row = spark.sql("select cast(null as int) i, cast(null as double) d, cast(null as string) s, cast(null as date) t, cast(null as boolean) b")
    assert tuple(ty.null_fill(row).first()) == (0, 0.0, "", None, None)


def test_stamp_snapshot(spark):
    frame = ty.stamp_snapshot(spark.range(1), "t")
    assert frame.first().asDict() == {"id": 0, "__op": "s", "__table": "t", "__source_ts_ms": 1618790418000, "__source_pos": 0}
    assert dict(frame.dtypes)["__source_ts_ms"] == "bigint"


# ---- dates, keys


def test_date_text_arithmetic_is_lenient(spark):
    rows = spark.createDataFrame([("2021-12-31",), ("2024-02-28",), ("2021-02-30",), ("2021-13-01",), ("bad",)], "d string")
    got = [r[0] for r in rows.select(add_days_text(F.col("d"), 1)).collect()]
    assert got == ["2022-01-01", "2024-02-29", "2021-03-03", "2022-01-02", None]


def test_day_parts_are_padded(spark):
    row = spark.sql("select date'2024-03-05' d").select(*day_parts(F.col("d"))).first()
    assert tuple(row) == ("2024", "03", "05")


def test_spec():
    assert split_keys("a, b") == ("a", "b")
    assert [buckets_for(n << 20) for n in (1, 512, 513, 5000, 100 << 20)] == [1, 1, 2, 16, 262144]
    with pytest.raises(ValueError):
        TableSpec("d", "t", ("id",), policy="newest")
    with pytest.raises(ValueError):
        TableSpec("d", "t", ())


# ---- latest, merge

CHANGES = "k bigint, t timestamp, p bigint, v string, _side string"


def changes(spark, rows):
    stamp = lambda d: None if d is None else dt.datetime(2024, 1, d)
    return spark.createDataFrame([(k, stamp(t), p, v, s) for k, t, p, v, s in rows], CHANGES)


def test_latest_orders_nulls_lowest_and_breaks_ties(spark):
    rows = [(1, None, 9, "null time", "upsert"), (1, 1, 1, "timed", "upsert"), (2, 1, 1, "a", "upsert"), (2, 1, 1, "b", "upsert"),
            (3, 2, 1, "early", "upsert"), (3, 2, 2, "late", "upsert")]
    got = lt.latest_per_key(changes(spark, rows), ["k"], ["t", "p"])
    assert {r.k: r.v for r in got.collect()} == {1: "timed", 2: "b", 3: "late"}


def test_latest_with_a_map_payload(spark):
    frame = spark.sql("select 1 k, 1 t, map('a', 'b') m union all select 1, 2, map('a', 'c')")
    assert lt.latest_per_key(frame, ["k"], ["t"]).first().m == {"a": "c"}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = lt.latest_per_key(frame, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    before = plan[plan.index("Exchange"):]
    assert "Partial" in before


@pytest.mark.parametrize("policy, kept", [(EVENT_ORDER, {2: "again", 3: "new"}), (ARRIVAL, {3: "new"})])
def test_delete_then_reinsert_in_one_batch(spark, policy, kept):
    rows = [(1, 1, 1, "a", "upsert"), (1, 2, 2, None, "delete"), (2, 1, 1, None, "delete"), (2, 2, 2, "again", "upsert"), (3, 1, 1, "new", "upsert")]
    made = mg.as_changes(changes(spark, rows), ["k"], ["t", "p"], batch=1)
    got = mg.visible(mg.reduce_changes(made, ["k"], ["t", "p"], policy))
    assert {r.k: r.v for r in got.collect()} == kept


def test_late_older_upsert_does_not_revive_a_deleted_key(spark):
    order = ["t", "p"]
    stored = mg.as_changes(changes(spark, [(1, 5, 1, None, "delete")]), ["k"], order, 1)
    late = mg.as_changes(changes(spark, [(1, 4, 9, "old", "upsert")]), ["k"], order, 2)
    assert mg.visible(mg.merge(stored, late, ["k"], order)).count() == 0
    assert mg.visible(mg.merge(stored, late, ["k"], order, ARRIVAL)).count() == 1


def test_a_delete_wins_an_exact_tie_and_keeps_only_key_and_order(spark):
    rows = [(1, 1, 1, "a", "upsert"), (1, 1, 1, "a", "delete")]
    made = mg.as_changes(changes(spark, rows), ["k"], ["t", "p"], 1)
    row = mg.reduce_changes(made, ["k"], ["t", "p"]).first()
    assert row._deleted and row.v is None and row.k == 1 and row.p == 1


def test_upsert_and_delete_rows(spark):
    stored = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    new = spark.createDataFrame([(2, "B", True), (3, "C", False)], "k int, v string, extra boolean")
    got = {(r.k, r.v, r.extra) for r in mg.upsert_rows(stored, new, ["k"]).collect()}
    assert got == {(1, "a", None), (None, "n", None), (2, "B", True), (3, "C", False)}
    assert {r.v for r in mg.delete_rows(stored, new, ["k"]).collect()} == {"a", "n"}


def test_batch_counts(spark):
    rows = changes(spark, [(1, 1, 1, "a", "upsert"), (1, 1, 1, "a", "delete"), (2, 1, 1, "a", "reject"), (2, 1, 1, "a", "upsert")])
    got = {r.k: (r.n_rows, r.n_upserts, r.n_deletes, r.n_rejected) for r in ev.batch_counts(rows, ["k"]).collect()}
    assert got == {1: (2, 1, 1, 0), 2: (2, 1, 0, 1)}


def test_preview_is_ordered(spark):
    frame = spark.range(100).withColumn("t", -F.col("id"))
    assert [r.id for r in lt.preview_topn(frame, ["id"], ["t"], 3).collect()] == [99, 98, 97]
