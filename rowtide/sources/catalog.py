"""Column catalog of the source databases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# INFORMATION_SCHEMA.COLUMNS columns and what they are called here.
COLUMNS = {
    "TABLE_SCHEMA": "database",
    "TABLE_NAME": "table",
    "COLUMN_NAME": "column",
    "DATA_TYPE": "data_type",
    "NUMERIC_PRECISION": "precision",
    "NUMERIC_SCALE": "scale",
}
CATALOG_VIEW = "INFORMATION_SCHEMA.COLUMNS"


def normalise(catalog: DataFrame) -> DataFrame:
    have = {c.upper(): c for c in catalog.columns}
    return catalog.select(
        *[F.col(have[src]).alias(dst) for src, dst in COLUMNS.items() if src in have]
    )


def read_catalog(
    spark: SparkSession, url: str, databases: Sequence[str], properties: Mapping[str, str]
) -> DataFrame:
    """Catalog of all listed databases in one read.

    Database names are a Column predicate, which Spark turns into a pushed, escaped WHERE;
    they never become part of a SQL text here. Credentials come in ``properties``.
    """
    raw = spark.read.jdbc(url, CATALOG_VIEW, properties=dict(properties))
    return normalise(raw.filter(F.col("TABLE_SCHEMA").isin(*databases)))


def read_catalog_files(spark: SparkSession, path: str) -> DataFrame:
    return normalise(spark.read.parquet(path))
