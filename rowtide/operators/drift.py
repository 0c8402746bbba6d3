"""Fields of events that the source catalog does not list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.schemas import VALUES_MAP


def drifted_columns(events: DataFrame, catalog: DataFrame, values: str = "values") -> DataFrame:
    """``schema, table, column, n_events, seen_type``: fields of the events' JSON rows that the catalog lacks.

    ``seen_type`` is the type that takes all values met, as Spark finds it in the JSON itself. Only (table, column) pairs
    are shuffled, after each task has put its own together. Tables without any catalog row are not drift and left out.
    """
    rows = events.select("schema", "table", F.try_parse_json(values).alias("_row"))
    field = events.sparkSession.tvf.variant_explode(F.col("_row").outer())
    fields = rows.lateralJoin(field).select("schema", "table", F.col("key").alias("column"), F.col("value").alias("_value"))
    found = fields.groupBy("schema", "table", "column").agg(F.count(F.lit(1)).alias("n_events"), F.schema_of_variant_agg("_value").alias("seen_type"))
    listed = catalog.select(F.col("database").alias("schema"), "table", "column").distinct()
    tables = listed.select("schema", "table").distinct()
    return found.join(tables, ["schema", "table"], "left_semi").join(listed, ["schema", "table", "column"], "left_anti")


def unlisted_fields(values: Column, columns: Sequence[str]) -> Column:
    """The fields of a JSON row (text) other than the given ones, as JSON text; null where there is none."""
    row = F.from_json(values, VALUES_MAP)
    rest = F.map_filter(row, lambda name, _: ~name.isin(list(columns)))
    return F.when(F.size(rest) > 0, F.to_json(rest, {"ignoreNullFields": "false"}))
