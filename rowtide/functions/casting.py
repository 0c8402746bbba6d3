"""Source-database types and casts that give null, never an error, on a bad value."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Source column type -> Spark SQL type.
MYSQL_TYPES = {
    "bigint": "bigint",
    "binary": "string",
    "bit": "bigint",
    "char": "string",
    "date": "date",
    "datetime": "timestamp",
    "decimal": "double",
    "double": "double",
    "enum": "string",
    "float": "double",
    "int": "bigint",
    "json": "string",
    "longtext": "string",
    "mediumint": "bigint",
    "mediumtext": "string",
    "set": "string",
    "smallint": "bigint",
    "text": "string",
    "time": "string",
    "timestamp": "timestamp",
    "tinyint": "bigint",
    "tinytext": "string",
    "varbinary": "string",
    "varchar": "string",
}
FALLBACK_TYPE = "string"

# Columns kept as another type than their catalog says; "*" is any database.
COLUMN_OVERRIDES = {("*", "b2c_pedped", "id_clicli"): "string"}


@dataclass(frozen=True)
class TypeRules:
    """How catalog types become Spark types."""

    datetime: str = "timestamp"  # or "timestamp_ntz": the source type carries no zone
    exact_decimal: bool = False  # decimal(p, s) where the catalog gives precision and scale
    overrides: dict[tuple[str, str, str], str] = field(
        default_factory=lambda: dict(COLUMN_OVERRIDES)
    )

    def table(self) -> dict[str, str]:
        return {**MYSQL_TYPES, "datetime": self.datetime}


def known_type(data_type: Column) -> Column:
    return data_type.isin(*MYSQL_TYPES)


def spark_type(
    data_type: Column,
    rules: TypeRules = TypeRules(),
    precision: Column | None = None,
    scale: Column | None = None,
) -> Column:
    """Spark type name of a catalog type; a literal map, so no join and nothing to broadcast."""
    pairs = [F.lit(x) for pair in rules.table().items() for x in pair]
    mapped = F.coalesce(F.create_map(*pairs)[data_type], F.lit(FALLBACK_TYPE))
    if rules.exact_decimal and precision is not None:
        exact = F.format_string("decimal(%d,%d)", precision, F.coalesce(scale, F.lit(0)))
        usable = (data_type == "decimal") & precision.between(1, 38)
        mapped = F.when(usable, exact).otherwise(mapped)
    return mapped


def override_type(
    database: Column, table: Column, column: Column, mapped: Column, rules: TypeRules = TypeRules()
) -> Column:
    def step(acc: Column, item) -> Column:
        (db, tab, col), wanted = item
        hit = (table == tab) & (column == col)
        if db != "*":
            hit = hit & (database == db)
        return F.when(hit, F.lit(wanted)).otherwise(acc)

    return reduce(step, rules.overrides.items(), mapped)


# Microseconds in a unit of time numbers; text: times are written out.
TIME_UNITS = {"text": None, "s": 1_000_000, "ms": 1_000, "us": 1}
_NUMBER = r"^-?\d+(\.\d+)?$"


def text_to_long(text: Column) -> Column:
    """Whole number in a text; fractions are cut off and JSON booleans count as 1 and 0.

    The first branch is the hot path; the others run only where it gives null. They go
    through DECIMAL, since DOUBLE would lose digits above 2**53.
    """
    return F.coalesce(
        text.try_cast("bigint"),
        text.try_cast("decimal(38,18)").try_cast("bigint"),
        F.when(text == "true", F.lit(1)).when(text == "false", F.lit(0)).cast("bigint"),
    )


def text_to_time(text: Column, target: str = "timestamp", unit: str = "ms") -> Column:
    """Timestamp in a text. A bare number counts ``unit``s since 1970, whatever its size; ``text``: no number is a time.

    Numbers go through DECIMAL, since DOUBLE would lose microseconds.
    """
    if unit not in TIME_UNITS:
        raise ValueError(f"unknown time unit {unit!r}, not one of {sorted(TIME_UNITS)}")
    stamp = text.try_cast(target)
    if TIME_UNITS[unit] is None:
        return F.when(~text.rlike(_NUMBER), stamp)
    micros = (text.try_cast("decimal(38,6)") * F.lit(TIME_UNITS[unit])).try_cast("bigint")
    return F.when(text.rlike(_NUMBER), F.timestamp_micros(micros).cast(target)).otherwise(stamp)


def safe_cast(col: Column, target: str, source: T.DataType = T.StringType(), unit: str = "ms") -> Column:
    if source.simpleString() == target:
        return col
    if isinstance(source, T.StringType):
        if target == "bigint":
            return text_to_long(col)
        if target.startswith("timestamp"):
            return text_to_time(col, target, unit)
        return col.try_cast(target)
    if target == "bigint" and isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.when(~F.isnan(col.cast("double")), col).try_cast("bigint")
    if target == "string":
        return col.cast("string")
    direct = isinstance(source, (T.NumericType, T.BooleanType)) and target in ("bigint", "double")
    times = (T.TimestampType, T.TimestampNTZType, T.DateType)
    if direct or target.startswith("decimal") and isinstance(source, T.NumericType):
        return col.try_cast(target)
    if isinstance(source, times) and target in ("date", "timestamp", "timestamp_ntz"):
        return col.try_cast(target)
    return safe_cast(col.cast("string"), target, unit=unit)
