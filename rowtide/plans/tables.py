"""What is needed to work on several tables at once: their columns, and bounded threads."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions.casting import TypeRules
from rowtide.operators.typed import catalog_types

Name = tuple[str, str]

NAME = T.StructType([T.StructField("schema", T.StringType()), T.StructField("table", T.StringType())])

# Fixed value: scheduler pool the table jobs run in.
POOL = "fair_pool"


def table_columns(
    tables: DataFrame, catalog: DataFrame, rules: TypeRules = TypeRules()
) -> dict[Name, list[tuple[str, str]]]:
    """(column, Spark type) of each (schema, table): metadata, so it fits the driver."""
    wanted = tables.select(F.col("schema").alias("database"), "table").distinct()
    listed = catalog.join(wanted, ["database", "table"], "left_semi")
    out: dict[Name, list[tuple[str, str]]] = {}
    for r in catalog_types(listed, rules).select("database", "table", "column", "spark_type").collect():
        out.setdefault((r["database"], r["table"]), []).append((r["column"], r["spark_type"]))
    return {name: sorted(columns) for name, columns in out.items()}


def for_each(
    spark: SparkSession, work: Iterable, fn: Callable, parallel: int = 8, pool: str = POOL
) -> list:
    """Run ``fn`` on every item in at most ``parallel`` driver threads.

    The threads only submit jobs. Each returns (item, result, error); no error is lost.
    """

    def guarded(item):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        try:
            return item, fn(item), None
        except Exception as error:  # reported by the caller, per table
            return item, None, error

    with ThreadPoolExecutor(max_workers=max(1, parallel)) as threads:
        # wrapped once per item: a wrapper holds one copy of the local properties
        running = [threads.submit(inheritable_thread_target(spark)(guarded), item) for item in work]
        return [r.result() for r in running]
