"""Rows that cannot be applied, with the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.schemas import QUARANTINE


def quarantine_rows(rows: DataFrame, reason: Column, batch: int, origin: str | Column, value: Column, writer: str) -> DataFrame:
    return rows.select(
        reason.cast("string").alias("reason"),
        F.col("schema"),
        F.col("table"),
        value.cast("string").alias("value"),
        F.lit(batch).cast("bigint").alias("batch_id"),
        (F.lit(origin) if isinstance(origin, str) else origin).alias("origin"),
        F.lit(writer).alias("writer"),
    )


def write_quarantine(rows: DataFrame, path: str) -> None:
    """Partitioned by writer, batch and origin and overwritten per partition, so a replay adds nothing.

    Each stream or job that shares the folder has a writer name of its own; batch numbers repeat among them.
    """
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("writer", "batch_id", "origin")
        .parquet(path)
    )


def read_quarantine(spark, path: str) -> DataFrame:
    return spark.read.schema(QUARANTINE).parquet(path)
