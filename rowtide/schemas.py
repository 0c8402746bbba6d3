"""Fixed record layouts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

CORRUPT = "_corrupt"

VALUES_MAP = T.MapType(T.StringType(), T.StringType())


def envelope(values: T.DataType = VALUES_MAP, extras: Sequence[str] = ()) -> T.StructType:
    """A row-change event. Values stay text until the column catalog of their own table types
    them, so one table's numbers never widen another table's."""
    text = ("schema", "table", "log_type", "date_action", "log_position")
    fields = [T.StructField(c, T.StringType()) for c in (*text, CORRUPT, *extras)]
    row = T.StructType([T.StructField("values", values)])
    return T.StructType([*fields, T.StructField("row", row)])


CONTROL = T.StructType(
    [
        T.StructField("database", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("table_id", T.StringType()),
        T.StructField("last_date", T.DateType()),
        T.StructField("first_load", T.BooleanType()),
        T.StructField("is_stream", T.BooleanType()),
    ]
)

METRIC = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("dimensions", T.MapType(T.StringType(), T.StringType())),
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("reason", T.StringType()),
        T.StructField("schema", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("origin", T.StringType()),
        T.StructField("writer", T.StringType()),
    ]
)
