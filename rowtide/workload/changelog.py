"""Change logs, control rows and catalogs that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.sources.events import spread

SCHEMA = "shop"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def _bin(k: Column) -> Column:
    return F.when(k < 33, "accounts").when(k < 66, "carts").otherwise("profiles")


def activity(spark: SparkSession, sf: str) -> DataFrame:
    """One row change per event: record ``id`` of one of three source tables gets a new value.

    The time is cut to the day, so the position decides within a day; ``batch`` is that day.
    """
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    op = (
        F.when(F.col("event_type") == "error", "DeleteRowsEvent")
        .when(F.col("event_type") == "signup", "WriteRowsEvent")
        .otherwise("UpdateRowsEvent")
    )
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return table(spark, sf, "events").select(
        F.lit(SCHEMA).alias("schema"),
        _bin(k).alias("table"),
        op.alias("log_type"),
        day.alias("date_action"),
        F.col("event_id").alias("log_position"),
        F.col("user_id").alias("id"),
        "value",
        F.to_date(day).alias("batch"),
        "event_type",
    )


# The same in DuckDB.
ACTIVITY = """
    select 'shop' as "schema",
           case when cast(regexp_extract(props, '[0-9]+') as bigint) < 33 then 'accounts'
                when cast(regexp_extract(props, '[0-9]+') as bigint) < 66 then 'carts'
                else 'profiles' end as "table",
           case event_type when 'error' then 'DeleteRowsEvent' when 'signup' then 'WriteRowsEvent'
                           else 'UpdateRowsEvent' end as log_type,
           date_trunc('day', ts)::timestamp as date_action,
           event_id as log_position,
           user_id as id,
           value,
           cast(ts as date) as batch,
           event_type
    from events
"""


def event_text(rows: DataFrame, values: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows as JSON events in a ``value`` column; a null value is left out of the event."""
    row = F.struct(F.struct(*values).alias("values"))
    event = F.struct("schema", "table", "log_type", "date_action", "log_position", row.alias("row"))
    return spread(rows, rows.sparkSession.sparkContext.defaultParallelism).select(*keep, F.to_json(event).alias("value"))


def activity_text(spark: SparkSession, sf: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return event_text(activity(spark, sf), ["id", "value"], keep)


ORDER_COLUMNS = [
    ("o_orderkey", "bigint"),
    ("o_custkey", "bigint"),
    ("o_orderstatus", "char"),
    ("o_totalprice", "decimal"),
    ("o_orderdate", "datetime"),
    ("o_orderpriority", "varchar"),
]
LINE_COLUMNS = [
    ("l_orderkey", "bigint"),
    ("l_partkey", "bigint"),
    ("l_suppkey", "bigint"),
    ("l_linenumber", "int"),
    ("l_quantity", "double"),
    ("l_extendedprice", "decimal"),
    ("l_discount", "decimal"),
    ("l_tax", "decimal"),
    ("l_returnflag", "char"),
    ("l_linestatus", "char"),
    ("l_shipdate", "datetime"),
]


def order_changes(spark: SparkSession, sf: str) -> DataFrame:
    op = (
        F.when(F.col("o_orderstatus") == "F", "DeleteRowsEvent")
        .when(F.col("o_orderstatus") == "O", "WriteRowsEvent")
        .otherwise("UpdateRowsEvent")
    )
    return table(spark, sf, "orders").withColumns(
        {
            "schema": F.lit(SCHEMA),
            "table": F.lit("orders"),
            "log_type": op,
            "date_action": F.col("o_orderdate"),
            "log_position": F.col("o_orderkey"),
        }
    )


def line_changes(spark: SparkSession, sf: str) -> DataFrame:
    op = (
        F.when(F.col("l_returnflag") == "R", "DeleteRowsEvent")
        .when(F.col("l_returnflag") == "N", "WriteRowsEvent")
        .otherwise("UpdateRowsEvent")
    )
    return table(spark, sf, "lineitem").withColumns(
        {
            "schema": F.lit(SCHEMA),
            "table": F.lit("lineitem"),
            "log_type": op,
            "date_action": F.col("l_shipdate"),
            "log_position": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        }
    )


def mixed_text(spark: SparkSession, sf: str) -> DataFrame:
    """Events of five source tables with different columns, in one stream."""
    orders = event_text(order_changes(spark, sf), [c for c, _ in ORDER_COLUMNS])
    lines = event_text(line_changes(spark, sf), [c for c, _ in LINE_COLUMNS])
    return orders.unionByName(lines).unionByName(activity_text(spark, sf))


def seen_catalog(events: DataFrame) -> DataFrame:
    """Column catalog of parsed events: the value names seen per table, typed by their endings."""
    name = F.col("column")
    kind = (
        F.when(name.rlike("(key|^id)$"), "bigint")
        .when(name.endswith("number"), "int")
        .when(name.endswith("date"), "datetime")
        .when(name.rlike("(price|quantity|discount|tax|value)$"), "decimal")
        .otherwise("varchar")
    )
    columns = events.select(
        F.col("schema").alias("database"), "table", F.explode(F.map_keys("values")).alias("column")
    ).distinct()
    return columns.withColumn("data_type", kind)


def mixed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """(schema, table) pairs of ``mixed_text``, without making the text."""
    logs = (order_changes, line_changes, activity)
    names = [log(spark, sf).select("schema", "table").distinct() for log in logs]
    return names[0].unionByName(names[1]).unionByName(names[2])


def registry(tables: DataFrame) -> DataFrame:
    """Control rows of the tables a change log names; ``profiles`` stays unregistered."""
    key = F.when(F.col("table") == "orders", "o_orderkey").when(
        F.col("table") == "lineitem", "l_orderkey, l_linenumber"
    )
    return (
        tables.select(F.col("schema").alias("database"), "table")
        .distinct()
        .filter(F.col("table") != "profiles")
        .withColumn("table_id", key.otherwise("id"))
    )


def declared_catalog(tables: DataFrame) -> DataFrame:
    """Column catalog of the tables a change log names, as their definitions give it."""

    def listed(columns) -> Column:
        return F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t).alias("data_type")) for c, t in columns])

    columns = F.when(F.col("table") == "orders", listed(ORDER_COLUMNS)).when(
        F.col("table") == "lineitem", listed(LINE_COLUMNS)
    )
    columns = columns.otherwise(listed([("id", "bigint"), ("value", "double")]))
    return tables.select(F.col("schema").alias("database"), "table", F.inline(columns))


def control(spark: SparkSession, sf: str) -> DataFrame:
    """One control row per customer: its orders are one source table."""
    orders = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.max("o_orderdate").cast("date").alias("last_date"),
        (F.count_if(F.col("o_orderstatus") == "F") == 0).alias("first_load"),
    )
    joined = table(spark, sf, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"))
    return joined.select(
        F.col("c_name").alias("database"),
        F.lit("orders").alias("table"),
        F.lit("o_orderkey").alias("table_id"),
        "last_date",
        "first_load",
        (F.col("c_mktsegment") == "BUILDING").alias("is_stream"),
    )


CONTROL = """
    select c_name as "database", 'orders' as "table", 'o_orderkey' as table_id,
           cast(last_ts as date) as last_date, n_finished = 0 as first_load,
           c_mktsegment = 'BUILDING' as is_stream
    from customer join (
        select o_custkey, max(o_orderdate) as last_ts,
               count(*) filter (where o_orderstatus = 'F') as n_finished
        from orders group by o_custkey
    ) on c_custkey = o_custkey
"""

# A type per position, the known ones and three without a rule.
TYPE_SAMPLES = [
    "bigint", "binary", "bit", "char", "date", "datetime", "decimal", "enum", "float", "int",
    "json", "longtext", "mediumint", "mediumtext", "set", "smallint", "text", "time", "timestamp",
    "tinyint", "tinytext", "varbinary", "varchar", "double", "longblob", "year", "geometry",
]


def part_catalog(spark: SparkSession, sf: str) -> DataFrame:
    """A column catalog: every part is a source column, its size picks the declared type.

    A hundred keys share a table name, so tables have a bounded number of columns, as real ones do.
    """
    names = F.array(*[F.lit(t) for t in TYPE_SAMPLES])
    return table(spark, sf, "part").select(
        F.col("p_brand").alias("database"),
        F.format_string("%s %d", "p_type", F.floor(F.col("p_partkey") / 100)).alias("table"),
        F.concat(F.lit("c"), F.col("p_partkey")).alias("column"),
        F.coalesce(F.get(names, F.col("p_size") - 1), F.lit("blob")).alias("data_type"),
    )


PART_CATALOG = f"""
    select p_brand as "database", p_type || ' ' || (p_partkey // 100) as "table", 'c' || p_partkey as "column",
           coalesce({TYPE_SAMPLES}[p_size], 'blob') as data_type
    from part
"""
