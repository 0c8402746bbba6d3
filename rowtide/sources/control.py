"""Control table: which tables to load, up to which day, under which key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions.dates import add_days, lenient_date
from rowtide.schemas import CONTROL

CONTROL_KEYS = ("database", "table")


def read_control(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Control rows from JSON or Parquet files; ``last_date`` may be yyyy-MM-dd text."""
    if fmt != "json":
        return spark.read.format(fmt).load(path)
    as_text = [(f.name, "string" if f.name == "last_date" else f.dataType.simpleString()) for f in CONTROL]
    raw = spark.read.schema(", ".join(f"`{n}` {t}" for n, t in as_text)).json(path)
    return raw.withColumn("last_date", lenient_date(F.col("last_date")))


def due(control: DataFrame, first_load: bool | None = None) -> DataFrame:
    """Tables to work on with the day to apply; True: snapshot loads, False: daily loads, None: both."""
    rows = control.withColumn("load_date", add_days(F.col("last_date"), 1))
    return rows if first_load is None else rows.filter(F.col("first_load") == first_load)


def advance(control: DataFrame, days: int | Column = 1) -> DataFrame:
    """The rows to put back once their work is done."""
    return control.withColumns(
        {
            "last_date": add_days(F.col("last_date"), days),
            "first_load": F.lit(False),
            "is_stream": F.lit(False),
        }
    ).select(*[f.name for f in CONTROL])


def stored_rows(rows: DataFrame, path: str) -> DataFrame:
    """Few rows written down and read back, so that Spark's size check sees them and not the tables they are made from."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def key_lookup(rows: DataFrame, control: DataFrame, database: str = "schema", table: str = "table") -> DataFrame:
    """``rows`` with the ``table_id`` of their table, null where the table is not registered.

    No forced broadcast: Spark broadcasts the control rows only while they are below its own
    size limit, and beyond it AQE splits the partition of a hot table. What that limit is held against is
    Spark's estimate: control rows that are made from large tables go through ``stored_rows`` first.
    """
    ids = control.select(
        F.col("database").alias("_db"), F.col("table").alias("_tab"), F.col("table_id")
    )
    on = (F.col(database) == F.col("_db")) & (F.col(table) == F.col("_tab"))
    return rows.join(ids, on, "left").drop("_db", "_tab")


def registered_only(rows: DataFrame, control: DataFrame, database: str = "schema", table: str = "table") -> DataFrame:
    known = control.select(F.col("database").alias(database), F.col("table").alias(table)).distinct()
    return rows.join(known, [database, table], "left_semi").select(*rows.columns)
