"""Snapshot and daily change files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import files


def read_snapshot(spark: SparkSession, template: str, database: str, table: str) -> DataFrame:
    """``template`` is a path with ``{database}`` and ``{table}``."""
    return spark.read.parquet(template.format(database=database, table=table))


def read_changes_for_day(
    spark: SparkSession,
    root: str,
    database: str,
    table: str,
    day: dt.date,
    layout: str = "hive",
    schema: T.StructType | None = None,
) -> DataFrame:
    """One day of a table's change files, with every column that any of them has.

    hive: ``root/db/table/year=2024/month=1/day=15`` (with or without leading zeros), plain: ``root/db/table/2024/01/15``.
    Only the day's folder is listed and read. A day that has not been delivered raises ``FileNotFoundError``.
    """
    base = f"{root.rstrip('/')}/{database}/{table}"
    folder = f"{base}/{day:%Y/%m/%d}" if layout == "plain" else _day_folder(spark, base, day)
    if folder is None or not files.exists(spark, folder):
        raise FileNotFoundError(f"no change files of {database}.{table} for {day} below {base}")
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    return reader.parquet(folder)


DAY = "_day"


def available_days(spark: SparkSession, root: str, database: str, table: str, first: dt.date, layout: str = "hive", most: int = 366) -> dict[dt.date, str]:
    """Days from ``first`` on up to the first that has not been delivered, with their folders; one listing per month."""
    base = f"{root.rstrip('/')}/{database}/{table}"
    found: dict[dt.date, str] = {}
    last = first + dt.timedelta(days=most)

    def numbered(folder: str, part: str) -> list[tuple[int, str]]:
        """Folders with their numbers; two may have the same one, padded and not."""
        names = [(n if layout == "plain" else n.removeprefix(f"{part}="), n) for n in files.child_names(spark, folder)]
        return sorted((int(x), f"{folder}/{n}") for x, n in names if x.isdigit())

    for year, in_year in numbered(base, "year"):
        for month, in_month in numbered(in_year, "month") if first.year <= year <= last.year else ():
            if (first.year, first.month) <= (year, month) <= (last.year, last.month):
                for day, folder in numbered(in_month, "day"):
                    found.setdefault(dt.date(year, month, day), folder)
    out = {}
    while len(out) < most and (day := first + dt.timedelta(days=len(out))) in found:
        out[day] = found[day]
    return out


def read_changes_for_days(spark: SparkSession, days: dict[dt.date, str], schema: T.StructType | None = None) -> DataFrame:
    """Days of change files (``available_days``) in one scan, with the day of each row as ``_day``."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", True)
    rows = reader.parquet(*days.values())
    parts = [F.regexp_extract("_metadata.file_path", r"(\d+)/(?:month=)?(\d+)/(?:day=)?(\d+)/[^/]*$", n).cast("int") for n in (1, 2, 3)]
    return rows.withColumn(DAY, F.make_date(*parts))


def _day_folder(spark: SparkSession, base: str, day: dt.date) -> str | None:
    """``base/year=y/month=m/day=d``, however its numbers are padded."""
    for part, wanted in (("year", day.year), ("month", day.month), ("day", day.day)):
        numbers = {n: n.partition("=")[2] for n in files.child_names(spark, base) if n.startswith(f"{part}=")}
        base = next((f"{base}/{n}" for n, x in sorted(numbers.items()) if x.isdigit() and int(x) == wanted), None)
        if base is None:
            return None
    return base


def write_changes_by_day(changes: DataFrame, root: str, database: str, table: str, time: str) -> None:
    """Hive-style daily files; ``rebalance`` splits a day that holds too many rows for one task."""
    parts = {"year": F.year(time), "month": F.month(time), "day": F.dayofmonth(time)}
    (
        changes.withColumns(parts)
        .hint("rebalance", *parts)
        .write.mode("overwrite")
        .partitionBy(*parts)
        .parquet(f"{root.rstrip('/')}/{database}/{table}")
    )
