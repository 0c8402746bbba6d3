"""Small driver-side rows as a frame."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_frame(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    """A handful of metadata rows; by way of Arrow, which needs no Python worker."""
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [[] for _ in arrow]
    data = [pa.array(list(c), f.type) for c, f in zip(columns, arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(data, schema=arrow), schema)
