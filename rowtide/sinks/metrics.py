"""Batch metrics as a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.frames import small_frame
from rowtide.schemas import METRIC

# Units a metric may have, and the metric names of a finished batch.
COUNT, MILLISECONDS, SECONDS, COUNT_SECOND = "Count", "Milliseconds", "Seconds", "CountSecond"
BATCH_COMPLETED, RECEIVER_ERROR = "batchCompleted", "receiverError"
SCHEDULING_DELAY, PROCESSING_DELAY = "schedulingDelay", "processingDelay"
NUM_RECORDS, TOTAL_DELAY = "numRecords", "totalDelay"


def metric_row(name, value, unit, batch, dimensions, ts=None) -> tuple:
    now = ts or dt.datetime.now(dt.timezone.utc)
    return (name, float(value), unit, batch, now, dict(dimensions))


def append_metrics(spark: SparkSession, rows: Iterable[tuple], path: str, writer: str) -> None:
    """A handful of rows per batch; they describe the batch and hold none of its data.

    Two appends to one folder at a time would share, and remove, the committer's scratch folder; so each writer, which
    is one thread, has a folder of its own.
    """
    rows = list(rows)
    if rows:
        small_frame(spark, rows, METRIC).coalesce(1).write.mode("append").parquet(f"{path}/writer={writer}")


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(METRIC).parquet(path).select(*METRIC.names)


def batch_metrics(metrics: DataFrame) -> DataFrame:
    """One row per batch; of a replayed batch the last report counts."""
    def last(name: str):
        return F.max_by(F.when(F.col("name") == name, F.col("value")), F.when(F.col("name") == name, F.col("ts")))

    names = (NUM_RECORDS, SCHEDULING_DELAY, PROCESSING_DELAY, TOTAL_DELAY)
    return metrics.groupBy("batch_id").agg(*[last(n).alias(n) for n in names])
