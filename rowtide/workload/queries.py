"""Every operator as a query over the given tables, with the SQL that gives the same rows."""

from __future__ import annotations

import dataclasses
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions.casting import MYSQL_TYPES, TypeRules
from rowtide.frames import small_frame
from rowtide.functions.dates import add_days_text
from rowtide.operators import events as ev
from rowtide.operators import latest as lt
from rowtide.operators import merge as mg
from rowtide.operators import typed as ty
from rowtide.operators.drift import drifted_columns as drifted
from rowtide.plans.batch import BatchJob, control_table, put_control, run_batch, run_days
from rowtide.session import configure, shared_dir
from rowtide.sinks.metrics import batch_metrics, read_metrics
from rowtide.sinks.quarantine import read_quarantine
from rowtide.sinks.table import LakeTable
from rowtide.sources import control as ct
from rowtide.sources.catalog import normalise, read_catalog_files
from rowtide.sources.events import event_stream, shard_union
from rowtide.sources.files import read_changes_for_day, read_snapshot, write_changes_by_day
from rowtide.sources.shards import EARLIEST, LATEST, shard_stream
from rowtide.spec import ARRIVAL, EVENT_ORDER, STREAM_ORDER, TableSpec
from rowtide.streaming.apply import ChangeApplier
from rowtide.streaming.job import run_available
from rowtide.streaming.replay import open_rejects, replay_rejects
from rowtide.workload import changelog as cl

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

NTZ = "timestamp_ntz"
SPARK_TYPES = TypeRules(datetime=NTZ)
ORDER_TYPES = [(c, SPARK_TYPES.table()[t]) for c, t in cl.ORDER_COLUMNS]
LINE_TYPES = [(c, SPARK_TYPES.table()[t]) for c, t in cl.LINE_COLUMNS]
ACTIVITY_TYPES = [("id", "bigint"), ("value", "double")]


def query(name: str, oracle: str | None = None):
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(configure(spark), sf_dir)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def parsed_activity(spark, sf, keep=()):
    return ev.parse_events(cl.activity_text(spark, sf, keep), time_type=NTZ)


# ---- parse, route, split


@query(
    "parse_events",
    f"""select "schema", "table", log_type, date_action, log_position,
        cast(id as varchar) as id_text, value from ({cl.ACTIVITY})""",
)
def parse_events(spark, sf):
    events = ev.accepted(parsed_activity(spark, sf))
    return events.select(
        "schema", "table", "log_type", "date_action", "log_position",
        F.col("values")["id"].alias("id_text"),
        F.col("values")["value"].try_cast("double").alias("value"),
    )


@query(
    "route_table",
    f"""select "schema", "table", log_type, log_position from ({cl.ACTIVITY})
        where "table" = 'accounts' and "schema" = 'shop'""",
)
def route_table(spark, sf):
    rows = ev.route_table(parsed_activity(spark, sf), cl.SCHEMA, "accounts")
    return rows.select("schema", "table", "log_type", "log_position")


_GAPPY_OP = "case when event_type = 'click' then null else log_type end"


@query(
    "split_ops_binlog",
    f"""select "table", log_position,
        case when op is null then 'reject' when op = 'DeleteRowsEvent' then 'delete' else 'upsert' end as side
        from (select *, {_GAPPY_OP} as op from ({cl.ACTIVITY}))""",
)
def split_ops_binlog(spark, sf):
    rows = cl.activity(spark, sf).withColumn("log_type", F.expr(_GAPPY_OP))
    return ev.tag_binlog(rows).select("table", "log_position", F.col(ev.SIDE).alias("side"))


_DEBEZIUM_OP = (
    "case event_type when 'signup' then 'c' when 'view' then 'u' when 'purchase' then 'u'"
    " when 'error' then 'd' else 'r' end"
)


@query(
    "split_ops_debezium",
    f"""select event_id, op,
        case when op in ('c', 'u') then 'upsert' when op = 'd' then 'delete' else 'reject' end as side
        from (select event_id, {_DEBEZIUM_OP} as op from events)""",
)
def split_ops_debezium(spark, sf):
    rows = cl.table(spark, sf, "events").select("event_id", F.expr(_DEBEZIUM_OP).alias("__op"))
    upserts, deletes, rejects = ev.split_ops(ev.tag_debezium(rows))
    sides = [
        part.select("event_id", F.col("__op").alias("op"), F.lit(side).alias("side"))
        for part, side in ((upserts, "upsert"), (deletes, "delete"), (rejects, "reject"))
    ]
    return shard_union(sides)


@query("distinct_tables", f"""select distinct "schema", "table" from ({cl.ACTIVITY})""")
def distinct_tables(spark, sf):
    return ev.distinct_tables(parsed_activity(spark, sf))


@query(
    "batch_counts",
    f"""select batch, "schema", "table", count(*) as n_rows,
        count(*) filter (where op <> 'DeleteRowsEvent') as n_upserts,
        count(*) filter (where op = 'DeleteRowsEvent') as n_deletes,
        count(*) filter (where op is null) as n_rejected
        from (select *, {_GAPPY_OP} as op from ({cl.ACTIVITY})) group by all""",
)
def batch_counts(spark, sf):
    rows = cl.activity(spark, sf).withColumn("log_type", F.expr(_GAPPY_OP))
    return ev.batch_counts(ev.tag_binlog(rows), ("batch", "schema", "table"))


@query(
    "flatten_row",
    f"""select "table", log_position, cast(id as varchar) as id,
        case when event_type <> 'error' then value end as value,
        event_type <> 'error' as has_value, cast(null as varchar) as note
        from ({cl.ACTIVITY})""",
)
def flatten_row(spark, sf):
    rows = cl.activity(spark, sf).withColumn("value", F.expr("if(event_type = 'error', null, value)"))
    events = ev.parse_events(cl.event_text(rows, ["id", "value"]), time_type=NTZ)
    present = events.withColumn("has_value", F.map_contains_key("values", F.lit("value")))
    flat = ty.flatten_row(present.drop("value"), ["id", "value", "note"])
    return flat.select(
        "table", "log_position", "id", F.col("value").try_cast("double").alias("value"), "has_value", "note"
    )


_LINE_OUT = ", ".join(c if c != "l_linenumber" else "cast(l_linenumber as bigint) as l_linenumber" for c, _ in cl.LINE_COLUMNS)


@query(
    "typed_rows",
    f"""select {_LINE_OUT}, l_shipdate as date_action,
        l_orderkey * 10 + l_linenumber as log_position, 'Streaming' as "Action" from lineitem""",
)
def typed_rows(spark, sf):
    text = cl.event_text(cl.line_changes(spark, sf), [c for c, _ in cl.LINE_COLUMNS])
    events = ev.parse_events(text, time_type=NTZ, values=T.StringType())
    return ty.typed_events(events, LINE_TYPES)


@query(
    "type_override",
    """select o_orderkey, cast(o_custkey as varchar) as o_custkey, o_totalprice, o_orderdate,
       o_orderdate as date_action, o_orderkey as log_position, 'Streaming' as "Action" from orders""",
)
def type_override(spark, sf):
    changes = cl.order_changes(spark, sf)
    text = cl.event_text(changes, [c for c, _ in cl.ORDER_COLUMNS])
    events = ev.parse_events(text, time_type=NTZ, values=T.StringType())
    rules = TypeRules(datetime=NTZ, overrides={(cl.SCHEMA, "orders", "o_custkey"): "string"})
    catalog = spark.createDataFrame(
        [(cl.SCHEMA, "orders", c, t) for c, t in cl.ORDER_COLUMNS],
        "database string, table string, column string, data_type string",
    )
    wanted = ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    types = {r["column"]: r["spark_type"] for r in ty.catalog_types(catalog, rules).collect()}
    return ty.typed_events(events, [(c, types[c]) for c in wanted])


@query(
    "null_fill",
    """select o_orderkey, o_custkey, o_totalprice, o_orderdate,
       coalesce(s_suppkey, 0) as s_suppkey, coalesce(s_name, '') as s_name,
       coalesce(s_nationkey, 0) as s_nationkey, coalesce(s_acctbal, 0) as s_acctbal
       from orders left join supplier on o_custkey = s_suppkey""",
)
def null_fill(spark, sf):
    orders = cl.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    supplier = cl.table(spark, sf, "supplier")
    return ty.null_fill(orders.join(supplier, F.col("o_custkey") == F.col("s_suppkey"), "left"))


# ---- catalog and control

_TYPE_CASE = "case data_type " + " ".join(f"when '{k}' then '{v}'" for k, v in MYSQL_TYPES.items()) + " else 'string' end"
_KNOWN = ", ".join(f"'{t}'" for t in MYSQL_TYPES)
_TYPED_CATALOG = f"""select "database", "table", "column", data_type, {_TYPE_CASE} as spark_type,
    data_type in ({_KNOWN}) as known from ({cl.PART_CATALOG})"""


def written_catalog(spark, sf):
    """The catalog as the source database shows it, stored as Parquet and read back."""
    names = {"database": "TABLE_SCHEMA", "table": "TABLE_NAME", "column": "COLUMN_NAME", "data_type": "DATA_TYPE"}
    path = shared_dir(spark, "catalog")
    cl.part_catalog(spark, sf).withColumnsRenamed(names).write.parquet(path)
    return read_catalog_files(spark, path)


@query("catalog_types", _TYPED_CATALOG)
def catalog_types(spark, sf):
    return ty.catalog_types(written_catalog(spark, sf))


@query("unknown_types", f"select * from ({_TYPED_CATALOG}) where not known")
def unknown_types(spark, sf):
    return ty.unknown_types(ty.catalog_types(cl.part_catalog(spark, sf)))


@query(
    "catalog_type_map",
    f"""select "database", "table", count(*) as n_columns,
        string_agg("column" || ' ' || spark_type, ',' order by "column") as columns
        from ({_TYPED_CATALOG}) group by all""",
)
def catalog_type_map(spark, sf):
    maps = ty.type_maps(ty.catalog_types(cl.part_catalog(spark, sf)))
    pairs = F.transform(F.map_entries("types"), lambda e: F.concat_ws(" ", e["key"], e["value"]))
    return maps.select(
        "database", "table", F.size("types").cast("bigint").alias("n_columns"),
        F.array_join(pairs, ",").alias("columns"),
    )


@query(
    "key_lookup",
    f"""select "schema", "table", log_position,
        case when "table" <> 'profiles' then 'id' end as table_id from ({cl.ACTIVITY})""",
)
def key_lookup(spark, sf):
    changes = cl.activity(spark, sf)
    return ct.key_lookup(changes, cl.registry(changes)).select("schema", "table", "log_position", "table_id")


@query(
    "registered_only",
    f"""select "schema", "table", log_position from ({cl.ACTIVITY}) where "table" <> 'profiles'""",
)
def registered_only(spark, sf):
    changes = cl.activity(spark, sf)
    rows = ct.registered_only(changes, cl.registry(changes))
    return rows.select("schema", "table", "log_position")


@query(
    "control_due",
    f"""select "database", "table", table_id, first_load, cast(last_date + 1 as date) as load_date
        from ({cl.CONTROL}) where first_load""",
)
def control_due(spark, sf):
    path = shared_dir(spark, "control")
    cl.control(spark, sf).write.json(path)
    rows = ct.due(ct.read_control(spark, path), first_load=True)
    return rows.select("database", "table", "table_id", "first_load", "load_date")


@query(
    "control_due_daily",
    f"""select "database", "table", cast(last_date + 1 as date) as load_date
        from ({cl.CONTROL}) where not first_load""",
)
def control_due_daily(spark, sf):
    return ct.due(cl.control(spark, sf), first_load=False).select("database", "table", "load_date")


@query(
    "control_advance",
    f"""select "database", "table", table_id, cast(last_date + 1 as date) as last_date,
        false as first_load, false as is_stream, strftime(last_date + 1, '%Y-%m-%d') as last_text
        from ({cl.CONTROL})""",
)
def control_advance(spark, sf):
    rows = cl.control(spark, sf)
    store = control_table(spark, shared_dir(spark, "control"))
    put_control(store, rows)
    put_control(store, ct.advance(store.read()))
    return store.read().withColumn("last_text", add_days_text(F.col("last_date").cast("string"), 0))


# ---- loads and scans


@query(
    "snapshot_load",
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
       's' as "__op", 'orders' as "__table", 1618790418000 as "__source_ts_ms",
       cast(0 as bigint) as "__source_pos", 'Hinata' as "Action" from orders""",
)
def snapshot_load(spark, sf):
    rows = ty.stamp_snapshot(read_snapshot(spark, f"{sf}/{{table}}.parquet", cl.SCHEMA, "orders"), "orders")
    typed = ty.typed_columns(ty.null_fill(rows), ORDER_TYPES, ty.BATCH_LABEL)
    spec = TableSpec(cl.SCHEMA, "orders", ("o_orderkey",), ("__source_ts_ms", "__source_pos"))
    lake = LakeTable(spark, shared_dir(spark, "snapshot"), spec)
    lake.bulk_load(typed)
    return lake.read()


_DAY = dt.date(2024, 1, 15)


@query(
    "daily_changes_scan",
    f"""select "schema", "table", log_type, log_position, id, value from ({cl.ACTIVITY})
        where batch = date '{_DAY}'""",
)
def daily_changes_scan(spark, sf):
    root = shared_dir(spark, "daily")
    changes = cl.activity(spark, sf)
    write_changes_by_day(changes, root, cl.SCHEMA, "activity", "batch")
    rows = read_changes_for_day(spark, root, cl.SCHEMA, "activity", _DAY)
    return rows.select("schema", "table", "log_type", "log_position", "id", "value")


# ---- latest per key, order, previews


@query(
    "latest_per_key",
    f"""select "table", id, log_type, date_action, log_position, value from (
        select *, row_number() over (partition by "table", id
            order by date_action desc nulls last, log_position desc nulls last) as rn
        from ({cl.ACTIVITY})) where rn = 1""",
)
def latest_per_key(spark, sf):
    rows = cl.activity(spark, sf).select("table", "id", "log_type", "date_action", "log_position", "value")
    return lt.latest_per_key(rows, ["table", "id"], STREAM_ORDER)


_LINE_REST = [c for c, _ in cl.LINE_COLUMNS if c not in ("l_orderkey", "l_linenumber", "l_shipdate")]
_LINE_RANK = ", ".join(f"{c} desc nulls last" for c in ["l_shipdate", *_LINE_REST])


@query(
    "latest_per_key_composite",
    f"""select * exclude (rn) from (select *, row_number() over (
        partition by l_orderkey, l_linenumber order by {_LINE_RANK}) as rn from lineitem) where rn = 1""",
)
def latest_per_key_composite(spark, sf):
    return lt.latest_per_key(cl.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "ordered_changes",
    f"""select "table", date_action, log_position, id from ({cl.ACTIVITY})
        order by date_action, log_position""",
)
def ordered_changes(spark, sf):
    rows = cl.activity(spark, sf).select("table", "date_action", "log_position", "id")
    return lt.ordered_changes(rows, STREAM_ORDER)


@query(
    "ordered_changes_debezium",
    """select epoch_ms(o_orderdate) as "__source_ts_ms", o_orderkey as "__source_pos", o_totalprice
       from orders order by 1, 2""",
)
def ordered_changes_debezium(spark, sf):
    ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    rows = cl.table(spark, sf, "orders").select(
        ms.alias("__source_ts_ms"), F.col("o_orderkey").alias("__source_pos"), "o_totalprice"
    )
    return lt.ordered_changes(rows, ("__source_ts_ms", "__source_pos"))


@query(
    "preview_topn",
    f"select date_action, log_position from ({cl.ACTIVITY}) order by date_action, log_position limit 10",
)
def preview_topn(spark, sf):
    return lt.preview_topn(cl.activity(spark, sf), ["date_action", "log_position"], STREAM_ORDER, 10)


@query("shard_union", f"""select event_type, "table", log_position, value from ({cl.ACTIVITY})""")
def shard_union_query(spark, sf):
    rows = cl.activity(spark, sf).select("event_type", "table", "log_position", "value")
    kinds = ("view", "signup", "error", "click", "purchase")
    rest = rows.filter(~F.col("event_type").isin(*kinds) | F.col("event_type").isNull())
    return shard_union([*[rows.filter(F.col("event_type") == k) for k in kinds], rest])


# ---- merges

# Stored rows are the orders; every line item is a change of its order, a returned one a delete.
_ORDER_CHANGES = """
    select l_orderkey as o_orderkey, l_shipdate as changed_at, l_linenumber as position,
           l_partkey as part, l_extendedprice as o_totalprice, l_linestatus as o_orderstatus,
           l_returnflag = 'R' as deleted
    from lineitem
"""
_CHANGE_RANK = """changed_at desc nulls last, position desc nulls last, {first}part desc nulls last,
    o_totalprice desc nulls last, o_orderstatus desc nulls last"""
_CHANGE_ORDER = ("changed_at", "position")


def line_rows(spark, sf):
    return cl.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_shipdate").alias("changed_at"),
        F.col("l_linenumber").alias("position"),
        F.col("l_partkey").alias("part"),
        F.col("l_extendedprice").alias("o_totalprice"),
        F.col("l_linestatus").alias("o_orderstatus"),
        F.when(F.col("l_returnflag") == "R", ev.DELETE).otherwise(ev.UPSERT).alias(ev.SIDE),
    )


def order_rows(spark, sf):
    return cl.table(spark, sf, "orders").select(
        "o_orderkey",
        F.col("o_orderdate").alias("changed_at"),
        F.lit(0).alias("position"),
        F.lit(None).cast("bigint").alias("part"),
        "o_totalprice",
        "o_orderstatus",
    )


_BASE = """select o_orderkey, o_orderdate as changed_at, 0 as position, cast(null as bigint) as part,
    o_totalprice, o_orderstatus from orders"""
_SHOWN = "o_orderkey, changed_at, position, part, o_totalprice, o_orderstatus"


@query(
    "merge_upsert",
    f"""with c as (select {_SHOWN} from (select *, row_number() over (partition by o_orderkey
            order by {_CHANGE_RANK.format(first='')}) as rn from ({_ORDER_CHANGES})) where rn = 1)
        select {_SHOWN} from ({_BASE}) b where not exists (select 1 from c where c.o_orderkey = b.o_orderkey)
        union all select {_SHOWN} from c""",
)
def merge_upsert(spark, sf):
    # without null keys, which no merge takes, both uses of the changes share one exchange
    lines = line_rows(spark, sf).drop(ev.SIDE).filter(F.col("o_orderkey").isNotNull())
    changes = lt.latest_per_key(lines, ["o_orderkey"], _CHANGE_ORDER)
    return mg.upsert_rows(order_rows(spark, sf), changes, ["o_orderkey"])


@query(
    "merge_delete",
    """select * from orders where not exists
       (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R')""",
)
def merge_delete(spark, sf):
    returned = cl.table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    keys = returned.select(F.col("l_orderkey").alias("o_orderkey"))
    return mg.delete_rows(cl.table(spark, sf, "orders"), keys, ["o_orderkey"])


_ACTIVITY_SHOWN = '"table", id, date_action, log_position, value'


def activity_changes(spark, sf):
    rows = cl.activity(spark, sf).select(
        "table", "id", "date_action", "log_position", "value", "log_type",
        F.unix_date("batch").cast("bigint").alias("_batch"),
    )
    return mg.as_changes(ev.tag_binlog(rows).drop("log_type"), ["table", "id"], STREAM_ORDER)


@query(
    "merge_event_order",
    f"""select {_ACTIVITY_SHOWN} from (select *, row_number() over (partition by "table", id
            order by date_action desc nulls last, log_position desc nulls last) as rn
        from ({cl.ACTIVITY})) where rn = 1 and log_type <> 'DeleteRowsEvent'""",
)
def merge_event_order(spark, sf):
    winners = mg.reduce_changes(activity_changes(spark, sf), ["table", "id"], STREAM_ORDER, EVENT_ORDER)
    return mg.visible(winners)


_ARRIVAL = f"""
    with last_batch as (
        select "table", id, max(batch) as batch from ({cl.ACTIVITY}) group by all),
    touched as (
        select a.* from ({cl.ACTIVITY}) a join last_batch using ("table", id, batch)),
    ranked as (
        select *, bool_or(log_type = 'DeleteRowsEvent') over (partition by "table", id) as gone,
               row_number() over (partition by "table", id
                   order by date_action desc nulls last, log_position desc nulls last) as rn
        from touched)
    select {_ACTIVITY_SHOWN} from ranked where rn = 1 and not gone"""


@query("merge_arrival", _ARRIVAL)
def merge_arrival(spark, sf):
    winners = mg.reduce_changes(activity_changes(spark, sf), ["table", "id"], STREAM_ORDER, ARRIVAL)
    return mg.visible(winners)


_MERGED_EVENT_ORDER = f"""
    select {_SHOWN} from (select *, row_number() over (partition by o_orderkey
            order by {_CHANGE_RANK.format(first='deleted desc, ')}) as rn
        from (select {_SHOWN}, deleted from ({_ORDER_CHANGES})
              union all select {_SHOWN}, false from ({_BASE})))
    where rn = 1 and not deleted"""


@query("merge_stored_event_order", _MERGED_EVENT_ORDER)
def merge_stored_event_order(spark, sf):
    keys = ["o_orderkey"]
    stored = order_rows(spark, sf).withColumn("_deleted", F.lit(False))
    changes = mg.reduce_changes(mg.as_changes(line_rows(spark, sf), keys, _CHANGE_ORDER), keys, _CHANGE_ORDER)
    return mg.visible(mg.merge(stored, changes, keys, _CHANGE_ORDER))


_MERGED_ARRIVAL = f"""
    with c as (select *, bool_or(deleted) over (partition by o_orderkey) as gone,
            row_number() over (partition by o_orderkey order by {_CHANGE_RANK.format(first='')}) as rn
        from ({_ORDER_CHANGES}))
    select {_SHOWN} from ({_BASE}) b where not exists (select 1 from c where c.o_orderkey = b.o_orderkey)
    union all select {_SHOWN} from c where rn = 1 and not gone"""


@query("merge_stored_arrival", _MERGED_ARRIVAL)
def merge_stored_arrival(spark, sf):
    keys = ["o_orderkey"]
    stored = order_rows(spark, sf).withColumns({"_deleted": F.lit(False), "_batch": F.lit(0).cast("bigint")})
    changes = mg.as_changes(line_rows(spark, sf), keys, _CHANGE_ORDER, batch=1)
    changes = mg.reduce_changes(changes, keys, _CHANGE_ORDER, ARRIVAL)
    return mg.visible(mg.merge(stored, changes, keys, _CHANGE_ORDER, ARRIVAL))


def _merged_table(spark, sf, policy):
    keys = ("o_orderkey",)
    lake = LakeTable(spark, shared_dir(spark, "merge"), TableSpec(cl.SCHEMA, "orders", keys, _CHANGE_ORDER, 8, policy))
    lake.bulk_load(order_rows(spark, sf))
    lake.merge(mg.as_changes(line_rows(spark, sf), keys, _CHANGE_ORDER, 1), 1)
    return lake


@query("merge_table_event_order", _MERGED_EVENT_ORDER)
def merge_table_event_order(spark, sf):
    return _merged_table(spark, sf, EVENT_ORDER).read()


@query("merge_table_arrival", _MERGED_ARRIVAL)
def merge_table_arrival(spark, sf):
    return _merged_table(spark, sf, ARRIVAL).read()


_PURGE_BEFORE = "1998-01-01"


@query(
    "purge_tombstones",
    f"""select o_orderkey, deleted from (select *, row_number() over (partition by o_orderkey
            order by {_CHANGE_RANK.format(first='deleted desc, ')}) as rn
        from (select {_SHOWN}, deleted from ({_ORDER_CHANGES})
              union all select {_SHOWN}, false from ({_BASE})))
    where rn = 1 and not coalesce(deleted and {_CHANGE_ORDER[0]} < timestamp '{_PURGE_BEFORE}', false)""",
)
def purge_tombstones(spark, sf):
    """What the table still holds, tombstones included: those from before the given day are gone."""
    lake = _merged_table(spark, sf, EVENT_ORDER)
    lake.purge_tombstones(dt.datetime.fromisoformat(_PURGE_BEFORE))
    return lake.rows().select("o_orderkey", F.col("_deleted").alias("deleted"))


@query("compact_table", _MERGED_EVENT_ORDER)
def compact_table(spark, sf):
    """Rows and changes written down as one generation, in twice the buckets."""
    lake = _merged_table(spark, sf, EVENT_ORDER)
    lake.compact(buckets=16)
    spec = dataclasses.replace(lake.spec, buckets=None)
    return LakeTable(spark, lake.root.removesuffix(f"/tables/{spec.database}/{spec.table}"), spec).read()


def _often_merged(spark, sf, merges=20, compact_at=()):
    """The orders under line items that come in many merges, each with keys of every bucket."""
    keys = ("o_orderkey",)
    lake = LakeTable(spark, shared_dir(spark, "often"), TableSpec(cl.SCHEMA, "orders_often", keys, _CHANGE_ORDER, 8))
    lake.bulk_load(order_rows(spark, sf))
    lines = line_rows(spark, sf)
    part = F.pmod(F.xxhash64("part", "position"), F.lit(merges))
    for n in range(merges):
        lake.merge(mg.as_changes(lines.filter(part == n), keys, _CHANGE_ORDER, n + 1), n + 1)
        if n in compact_at:
            lake.compact()
    return lake


@query("merge_table_many_merges", _MERGED_EVENT_ORDER)
def merge_table_many_merges(spark, sf):
    """Twenty merges of scattered keys, then one read that lays their reduced changes over the rows."""
    return _often_merged(spark, sf).read()


@query("merge_table_compacted_between", _MERGED_EVENT_ORDER)
def merge_table_compacted_between(spark, sf):
    """Compaction by bucket in the midst of merges."""
    return _often_merged(spark, sf, 6, (1, 4)).read()


@query("registered_after_merges", _MERGED_EVENT_ORDER)
def registered_after_merges(spark, sf):
    """The same rows by the name in the catalog."""
    return spark.table(_often_merged(spark, sf, 4).register("often_"))


@query("catalog_register", "select o_orderkey, o_custkey, o_totalprice, o_orderdate from orders")
def catalog_register(spark, sf):
    rows = cl.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    lake = LakeTable(spark, shared_dir(spark, "registered"), TableSpec(cl.SCHEMA, "orders_copy", ("o_orderkey",)))
    lake.bulk_load(rows)
    return spark.table(lake.register())


# ---- quarantine, metrics

_DAMAGE = (
    "case when event_type = 'view' then 'malformed_json' when event_type = 'click' then 'no_operation'"
    " when event_type = 'purchase' then 'no_table' end"
)


@query(
    "quarantine",
    f"select event_id, {_DAMAGE} as reason from events where event_type in ('view', 'click', 'purchase')",
)
def quarantine(spark, sf):
    rows = cl.activity(spark, sf).withColumns(
        {
            "event_id": F.col("log_position"),
            "log_type": F.expr("if(event_type = 'click', null, log_type)"),
            "table": F.expr("if(event_type = 'purchase', null, table)"),
        }
    )
    text = cl.event_text(rows, ["id", "value"], ("event_id", "event_type"))
    cut = F.expr("if(event_type = 'view', substr(value, 1, length(value) - 3), value)")
    bad = ev.rejected(ev.parse_events(text.withColumn("value", cut), time_type=NTZ))
    return bad.select("event_id", F.col(ev.REASON).alias("reason"))


@query(
    "batch_metrics",
    f"""select cast(batch - date '1970-01-01' as bigint) as batch_id, cast(count(*) as double) as "numRecords",
        cast(count(*) filter (where log_type = 'DeleteRowsEvent') as double) as "schedulingDelay",
        cast(max(log_position) - min(log_position) as double) as "processingDelay",
        cast(count(*) filter (where log_type = 'DeleteRowsEvent') + max(log_position) - min(log_position) as double)
            as "totalDelay"
        from ({cl.ACTIVITY}) group by batch""",
)
def batch_metrics_query(spark, sf):
    """Metric rows whose numbers come from the log itself, since measured times differ per run."""
    deletes = F.count_if(F.col("log_type") == "DeleteRowsEvent")
    span = F.max("log_position") - F.min("log_position")
    values = {"numRecords": F.count(F.lit(1)), "schedulingDelay": deletes, "processingDelay": span, "totalDelay": deletes + span}
    wide = cl.activity(spark, sf).groupBy(F.unix_date("batch").cast("bigint").alias("batch_id"), "date_action").agg(
        *[v.cast("double").alias(n) for n, v in values.items()]
    )
    rows = wide.unpivot(["batch_id", "date_action"], list(values), "name", "value")
    return batch_metrics(rows.withColumnRenamed("date_action", "ts"))


# ---- whole jobs

_LAST_ACTIVITY = f"""
    select *, row_number() over (partition by "table", id
        order by date_action desc nulls last, log_position desc nulls last) as rn from ({cl.ACTIVITY})"""


def _activity_applier(spark, root, sf, policy=EVENT_ORDER):
    names = cl.activity(spark, sf).select("schema", "table").distinct()
    control = names.select(F.col("schema").alias("database"), "table", F.lit("id").alias("table_id"))
    catalog = cl.declared_catalog(names)
    return ChangeApplier(
        spark, root, lambda: control, lambda: catalog, policy, SPARK_TYPES, NTZ, default_buckets=4, prefix="replay_",
        parse_tasks=spark.sparkContext.defaultParallelism,
    )


def _read_tables(spark, root, specs):
    parts = [
        LakeTable(spark, root, s).read().withColumn("table", F.lit(s.table)) for s in specs
    ]
    return shard_union(parts)


def _activity_specs(policy=EVENT_ORDER):
    return [TableSpec(cl.SCHEMA, t, ("id",), buckets=4, policy=policy) for t in ("accounts", "carts", "profiles")]


def replay(spark, sf, policy=EVENT_ORDER, files_per_batch=10):
    """The change log as JSON files by day, streamed through the applier until it is used up."""
    root = shared_dir(spark, "replay")
    text = cl.activity_text(spark, sf, ("batch",))
    text.hint("rebalance", "batch").write.partitionBy("batch").text(f"{root}/in")
    applier = _activity_applier(spark, f"{root}/lake", sf, policy)
    source = event_stream(spark, "text", path=f"{root}/in/*/*.txt", maxFilesPerTrigger=str(files_per_batch))
    run_available(source, applier, f"{root}/checkpoint")
    return applier


@query(
    "stream_replay",
    f"""select {_ACTIVITY_SHOWN}, 'Streaming' as "Action" from ({_LAST_ACTIVITY})
        where rn = 1 and log_type <> 'DeleteRowsEvent'""",
)
def stream_replay(spark, sf):
    applier = replay(spark, sf)
    return _read_tables(spark, applier.root, _activity_specs())


_TIES = ", ".join(f"{c} desc nulls last" for c in sorted(_LINE_REST) )


@query(
    "fanout_tables",
    f"""select 'lineitem' as "table", count(*) as n_rows, cast(sum(l_orderkey * 10 + l_linenumber) as bigint) as position_sum,
            round(sum(l_extendedprice), 2) as amount
        from (select *, row_number() over (partition by l_orderkey, l_linenumber
                order by l_shipdate desc nulls last, l_returnflag = 'R' desc, {_TIES}) as rn from lineitem)
        where rn = 1 and l_returnflag <> 'R'
        union all
        select 'orders', count(*), cast(sum(o_orderkey) as bigint), round(sum(o_totalprice), 2)
        from orders where o_orderstatus <> 'F'
        union all
        select "table", count(*), cast(sum(log_position) as bigint), round(sum(value), 2) from ({_LAST_ACTIVITY})
        where rn = 1 and log_type <> 'DeleteRowsEvent' and "table" <> 'profiles' group by "table" """,
)
def fanout_tables(spark, sf):
    root = shared_dir(spark, "fanout")
    text = cl.mixed_text(spark, sf)
    tables = cl.mixed_tables(spark, sf)
    control, catalog = cl.registry(tables), cl.declared_catalog(tables)
    applier = ChangeApplier(
        spark, root, lambda: control, lambda: catalog, EVENT_ORDER, SPARK_TYPES, NTZ, default_buckets=8, prefix="fanout_",
        parse_tasks=spark.sparkContext.defaultParallelism,
    )
    applier(text, 0)
    amounts = {"orders": ("o_orderkey", "o_totalprice"), "accounts": ("id", "value"), "carts": ("id", "value")}
    amounts["lineitem"] = ("l_orderkey, l_linenumber", "l_extendedprice")
    parts = [
        LakeTable(spark, root, TableSpec(cl.SCHEMA, t, tuple(k.split(", "))))
        .read()
        .select(F.lit(t).alias("table"), "log_position", F.col(a).alias("amount"))
        for t, (k, a) in amounts.items()
    ]
    return shard_union(parts).groupBy("table").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("log_position").alias("position_sum"),
        F.round(F.sum("amount"), 2).alias("amount"),
    )


_MANY = 200


@query(
    "many_tables",
    f"""select "table", id, date_action, log_position, value from (
            select *, row_number() over (partition by "table", id order by date_action desc, log_position desc) as rn
            from (select * replace ('t' || (log_position % {_MANY}) as "table") from ({cl.ACTIVITY})))
        where rn = 1 and log_type <> 'DeleteRowsEvent'""",
)
def many_tables(spark, sf):
    """The events dealt over two hundred small tables, applied as one batch."""
    root = shared_dir(spark, "many")
    rows = cl.activity(spark, sf).withColumn("table", F.concat(F.lit("t"), F.pmod("log_position", F.lit(_MANY))))
    names = rows.select("schema", "table").distinct()
    control = names.select(F.col("schema").alias("database"), "table", F.lit("id").alias("table_id"))
    catalog = cl.declared_catalog(names)
    applier = ChangeApplier(spark, root, lambda: control, lambda: catalog, EVENT_ORDER, SPARK_TYPES, NTZ, default_buckets=1, prefix=None)
    applier(cl.event_text(rows, ["id", "value"]), 0)
    specs = [TableSpec(cl.SCHEMA, r["table"], ("id",), buckets=1) for r in names.collect()]
    return _read_tables(spark, root, specs).select("table", "id", "date_action", "log_position", "value")


@query(
    "drifted_columns",
    f"""select 'shop' as "schema", "table", 'kind' as "column", count(*) as n_events, 'STRING' as seen_type
        from ({cl.ACTIVITY}) where event_type is not null group by "table"
        union all
        select 'shop', "table", 'size', count(*), 'BIGINT' from ({cl.ACTIVITY}) where log_position % 3 = 0 group by "table" """,
)
def drifted_columns(spark, sf):
    """Fields that the catalog does not list yet, as the events bring them."""
    rows = cl.activity(spark, sf).withColumns({"kind": F.col("event_type"), "size": F.expr("if(log_position % 3 = 0, 1000 + log_position, null)")})
    parsed = ev.accepted(ev.parse_events(cl.event_text(rows, ["id", "value", "kind", "size"]), time_type=NTZ, values=T.StringType()))
    return drifted(parsed, cl.declared_catalog(rows.select("schema", "table").distinct()))


@query(
    "quarantine_replay",
    f"""select 'table' as what, "table", count(*) as n from ({_LAST_ACTIVITY}) where rn = 1 and log_type <> 'DeleteRowsEvent' group by "table"
        union all
        select 'sent', 'profiles', count(*) from ({cl.ACTIVITY}) where "table" = 'profiles'
        union all
        select 'open', 'none', 0""",
)
def quarantine_replay(spark, sf):
    """Events of a table that is registered late: rejected, then sent once more, then settled."""
    root = shared_dir(spark, "replayed")
    rows = cl.activity(spark, sf)
    names = rows.select("schema", "table").distinct()
    early, catalog = cl.registry(names), cl.declared_catalog(names)
    late = names.select(F.col("schema").alias("database"), "table", F.lit("id").alias("table_id"))
    ChangeApplier(spark, root, lambda: early, lambda: catalog, EVENT_ORDER, SPARK_TYPES, NTZ, default_buckets=4, prefix="late_")(cl.event_text(rows, ["id", "value"]), 0)
    again = ChangeApplier(spark, root, lambda: late, lambda: catalog, EVENT_ORDER, SPARK_TYPES, NTZ, default_buckets=4, prefix="late_", name="replay")
    sent = replay_rejects(again)
    replay_rejects(again)
    left = open_rejects(spark, again.quarantine_path, f"{root}/replay/replay").count()
    counts = _read_tables(spark, root, _activity_specs()).groupBy("table").agg(F.count(F.lit(1)).alias("n"))
    report = small_frame(spark, [("sent", "profiles", sent), ("open", "none", left)], T.StructType([T.StructField("what", T.StringType()), T.StructField("table", T.StringType()), T.StructField("n", T.LongType())]))
    return counts.select(F.lit("table").alias("what"), "table", "n").unionByName(report)


@query(
    "quarantine_sink",
    f"""select 'no_key' as reason, 'shop' as "schema", 'profiles' as "table", count(*) as n_rows
        from ({cl.ACTIVITY}) where "table" = 'profiles' having count(*) > 0""",
)
def quarantine_sink(spark, sf):
    """Rows of an unregistered table end in the quarantine table, with their values."""
    root = shared_dir(spark, "quarantine")
    text = cl.activity_text(spark, sf)
    seen = ev.accepted(ev.parse_events(text, time_type=NTZ))
    control, catalog = cl.registry(seen), cl.seen_catalog(seen)
    applier = ChangeApplier(spark, root, lambda: control, lambda: catalog, EVENT_ORDER, SPARK_TYPES, NTZ, prefix="bad_")
    applier(text, 0)
    rows = read_quarantine(spark, applier.quarantine_path)
    return rows.groupBy("reason", "schema", "table").agg(F.count(F.lit(1)).alias("n_rows"))


_JOB_DAY = dt.date(2024, 1, 1)


def _job_world(spark, sf, day):
    """Daily files of all events, and a control table whose tables were last loaded on ``day``."""
    root = shared_dir(spark, "job")
    changes = cl.table(spark, sf, "events").select(
        "user_id", "value", F.expr(_DEBEZIUM_OP).alias("__op"), F.lit("activity").alias("__table"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("__source_ts_ms"),
        F.col("event_id").alias("__source_pos"), "ts",
    )
    write_changes_by_day(changes, f"{root}/changes", cl.SCHEMA, "activity", "ts")
    control = control_table(spark, root)
    rows = [
        (cl.SCHEMA, "orders", "o_orderkey", day, True, False),
        (cl.SCHEMA, "activity", "user_id", day, False, False),
    ]
    put_control(control, spark.createDataFrame(rows, ct.CONTROL))
    columns = [("orders", c, t) for c, t in cl.ORDER_COLUMNS]
    columns += [("activity", "user_id", "bigint"), ("activity", "value", "double")]
    catalog = normalise(
        spark.createDataFrame(
            [(cl.SCHEMA, *c) for c in columns],
            "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, DATA_TYPE string",
        )
    )
    job = BatchJob(f"{root}/lake", f"{sf}/{{table}}.parquet", f"{root}/changes", rules=SPARK_TYPES, default_buckets=4, prefix="job_")
    return job, control, catalog


def _raise_first(outcome):
    if outcome.failed:
        raise outcome.failed[0][1]
    return outcome


@query(
    "batch_job",
    f"""with day_changes as (
            select user_id, value, epoch_ms(ts) as ms, event_id, {_DEBEZIUM_OP} as op
            from events where cast(ts as date) = date '{_JOB_DAY}'),
        ranked as (select *, row_number() over (partition by user_id order by ms desc, event_id desc) as rn
                   from day_changes where op <> 'r')
        select 'orders' as "table", count(*) as n_rows, cast(sum(o_orderkey) as bigint) as key_sum from orders
        union all
        select 'activity', count(*), cast(sum(user_id) as bigint) from ranked where rn = 1 and op <> 'd'""",
)
def batch_job(spark, sf):
    """Snapshot load of one table and a daily load of another, driven by control rows."""
    job, control, catalog = _job_world(spark, sf, _JOB_DAY - dt.timedelta(days=1))
    _raise_first(run_batch(spark, job, control, catalog))
    parts = [
        LakeTable(spark, job.root, job.spec(cl.SCHEMA, t, k)).read().select(F.lit(t).alias("table"), F.col(k).alias("key"))
        for t, k in (("orders", "o_orderkey"), ("activity", "user_id"))
    ]
    return shard_union(parts).groupBy("table").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("key").alias("key_sum")
    )


@query(
    "daily_job_all_days",
    f"""with ranked as (select user_id, value, epoch_us(ts) // 1000 as ms, event_id, {_DEBEZIUM_OP} as op,
                row_number() over (partition by user_id order by epoch_us(ts) // 1000 desc, event_id desc) as rn
            from events where {_DEBEZIUM_OP} <> 'r')
        select user_id, value, ms as source_ts_ms, event_id as source_pos from ranked where rn = 1 and op <> 'd'""",
)
def daily_job_all_days(spark, sf):
    """Day after day of all events, until the next day is not there."""
    first = cl.table(spark, sf, "events").agg(F.min(F.to_date("ts"))).first()[0]
    job, control, catalog = _job_world(spark, sf, first - dt.timedelta(days=1))
    outcome = _raise_first(run_days(spark, job, control, catalog))
    if (cl.SCHEMA, "activity") not in outcome.absent:
        raise ValueError(f"the job did not go on to the last day: {outcome}")
    rows = LakeTable(spark, job.root, job.spec(cl.SCHEMA, "activity", "user_id")).read()
    return rows.select(
        "user_id", "value", F.col("__source_ts_ms").alias("source_ts_ms"), F.col("__source_pos").alias("source_pos")
    )


@query(
    "event_time_units",
    """select event_id, unit, ts from events, (values ('text'), ('s'), ('ms'), ('us')) as u(unit)""",
)
def event_time_units(spark, sf):
    """The time of each event read back from text and from numbers of every unit."""
    events = cl.table(spark, sf, "events").select("event_id", "ts")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    forms = {
        "text": F.col("ts").cast("string"),
        "s": (micros.cast("decimal(38,6)") / 1_000_000).cast("decimal(38,6)").cast("string"),
        "ms": (micros.cast("decimal(38,6)") / 1_000).cast("decimal(38,6)").cast("string"),
        "us": micros.cast("string"),
    }
    parts = []
    for unit, form in forms.items():
        event = F.to_json(F.struct(F.lit("s").alias("schema"), F.lit("t").alias("table"), F.lit("x").alias("log_type"), form.alias("date_action"), F.col("event_id").alias("log_position"), F.struct(F.create_map(F.lit("id"), F.lit("1")).alias("values")).alias("row")))
        parsed = ev.accepted(ev.parse_events(events.select(event.alias("value")), time_type=NTZ, time_unit=unit))
        parts.append(parsed.select(F.col("log_position").alias("event_id"), F.lit(unit).alias("unit"), F.col("date_action").alias("ts")))
    return shard_union(parts)


@query(
    "quarantine_two_streams",
    f"""select writer, reason, "table", log_position from (
            select *, case when "table" = 'carts' then 'slow' else 'quick' end as writer,
                   case when log_type = 'DeleteRowsEvent' then 'no_operation' when "table" = 'profiles' then 'no_key' end as reason
            from ({cl.ACTIVITY})) where reason is not null""",
)
def quarantine_two_streams(spark, sf):
    """Two streams over one root, each with its own tables and its own rejects."""
    root = shared_dir(spark, "two")
    rows = cl.activity(spark, sf)
    known = rows.filter("table <> 'profiles'")
    control, catalog = cl.registry(known), cl.declared_catalog(known.select("schema", "table").distinct())
    damaged = rows.withColumn("log_type", F.expr("if(log_type = 'DeleteRowsEvent', null, log_type)"))
    text = cl.event_text(damaged, ["id", "value"])
    slow = frozenset({(cl.SCHEMA, "carts")})
    for number, how in enumerate(({"name": "slow", "only": slow}, {"name": "quick", "skip": slow})):
        applier = ChangeApplier(spark, root, lambda: control, lambda: catalog, EVENT_ORDER, SPARK_TYPES, NTZ, prefix=f"two{number}_", **how)
        applier(text, 0)
    bad = read_quarantine(spark, applier.quarantine_path)
    position = F.get_json_object("value", "$.log_position").cast("bigint")
    return bad.select("writer", "reason", "table", position.alias("log_position"))


@query(
    "stream_restart",
    f"""select {_ACTIVITY_SHOWN}, 'Streaming' as "Action" from ({_LAST_ACTIVITY})
        where rn = 1 and log_type <> 'DeleteRowsEvent'""",
)
def stream_restart(spark, sf):
    """A stream that ends when half of the files are there, and goes on from its checkpoint when the rest is."""
    root = shared_dir(spark, "restart")
    text = cl.activity_text(spark, sf, ("batch",)).withColumn("half", F.pmod(F.unix_date("batch"), F.lit(2)))
    for half in (0, 1):
        text.filter(F.col("half") == half).hint("rebalance", "batch").select("value").write.mode("append").text(f"{root}/in")
        source = event_stream(spark, "text", path=f"{root}/in", maxFilesPerTrigger="10")
        run_available(source, _activity_applier(spark, f"{root}/lake", sf), f"{root}/checkpoint")
    return _read_tables(spark, f"{root}/lake", _activity_specs())


def append_shards(spark, sf, path, third):
    """A third of the days of the events, as the next segment of each of seven shards of a log."""
    text = cl.event_text(cl.activity(spark, sf), ["id", "value"], ("batch", "log_position"))
    rows = text.filter(F.pmod(F.unix_date("batch"), F.lit(3)) == third)
    rows.select(F.pmod("log_position", F.lit(7)).alias("shard"), F.lit(f"{third:06}").alias("segment"), "value").write.mode("append").partitionBy(
        "shard", "segment"
    ).text(path)


@query(
    "shard_replay",
    f"""select {_ACTIVITY_SHOWN}, 'Streaming' as "Action" from ({_LAST_ACTIVITY})
        where rn = 1 and log_type <> 'DeleteRowsEvent'""",
)
def shard_replay(spark, sf):
    """A sharded log from its earliest record, in three runs of the stream, each with a new segment of every shard."""
    root = shared_dir(spark, "shards")
    for third in range(3):
        append_shards(spark, sf, f"{root}/log", third)
        source = shard_stream(spark, f"{root}/log", f"{root}/checkpoint", EARLIEST)
        run_available(source, _activity_applier(spark, f"{root}/lake", sf), f"{root}/checkpoint")
    return _read_tables(spark, f"{root}/lake", _activity_specs())


@query(
    "shard_latest",
    f"""select log_position, cast(log_position % 7 as varchar) as shard from ({cl.ACTIVITY})
        where (batch - date '1970-01-01') % 3 > 0""",
)
def shard_latest(spark, sf):
    """A sharded log from its latest record: what was there when the stream first ran is left out, all that follows isn't."""
    root = shared_dir(spark, "shards")
    for third in range(3):
        append_shards(spark, sf, f"{root}/log", third)
        source = shard_stream(spark, f"{root}/log", f"{root}/checkpoint", LATEST, split_bytes=1 << 20, where=True)
        sink = source.writeStream.format("parquet").option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/out")
        sink.trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.schema("value string, shard string").parquet(f"{root}/out")
    return rows.select(F.get_json_object("value", "$.log_position").cast("bigint").alias("log_position"), "shard")


@query(
    "stream_metrics",
    f"""select 'numRecords' as name, cast(null as varchar) as "table", cast(count(*) as double) as total from ({cl.ACTIVITY})
        union all select 'tableRecords', "table", count(*) from ({cl.ACTIVITY}) group by "table"
        union all select 'quarantined', null, 0""",
)
def stream_metrics(spark, sf):
    """What the listener and the applier wrote down in a replay of all events; no times, since these differ per run."""
    applier = replay(spark, sf)
    rows = read_metrics(spark, applier.metrics_path).filter(F.col("name").isin("numRecords", "tableRecords", "quarantined"))
    return rows.groupBy("name", F.col("dimensions")["table"].alias("table")).agg(F.sum("value").alias("total"))


@query(
    "cast_report",
    """select 'castFailures' as what, count(*) as n from lineitem where l_linenumber = 3
       union all select 'bad_time', count(*) from lineitem where l_linenumber = 5""",
)
def cast_report(spark, sf):
    """Line items as text, some with a quantity that is no number or a time that is none: both are reported."""
    root = shared_dir(spark, "casts")
    rows = cl.line_changes(spark, sf).withColumns(
        {
            "l_quantity": F.expr("if(l_linenumber = 3, 'many', string(l_quantity))"),
            "date_action": F.expr("if(l_linenumber = 5, 'soon', string(date_action))"),
        }
    )
    known = rows.select("schema", "table").distinct()
    control, catalog = cl.registry(known), cl.declared_catalog(known)
    applier = ChangeApplier(
        spark, root, lambda: control, lambda: catalog, EVENT_ORDER, SPARK_TYPES, NTZ, prefix="casts_",
        parse_tasks=spark.sparkContext.defaultParallelism,
    )
    applier(cl.event_text(rows, [c for c, _ in cl.LINE_COLUMNS]), 0)
    lost = read_metrics(spark, applier.metrics_path).filter("name = 'castFailures'")
    bad = read_quarantine(spark, applier.quarantine_path).filter("reason = 'bad_time'")
    lost = lost.agg(F.coalesce(F.sum("value"), F.lit(0)).cast("bigint").alias("n")).select(F.lit("castFailures").alias("what"), "n")
    return lost.union(bad.agg(F.count("*").alias("n")).select(F.lit("bad_time").alias("what"), "n"))
