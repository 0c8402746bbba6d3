"""Column typing by the source catalog, null fill, snapshot stamps."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions.casting import TypeRules, known_type, override_type, safe_cast, spark_type
from rowtide.operators.drift import unlisted_fields
from rowtide.operators.events import SNAPSHOT_OP
from rowtide.spec import BOOKKEEPING

# Lineage labels of streamed and batch rows, and the stamp of snapshot rows.
STREAM_LABEL = "Streaming"
BATCH_LABEL = "Hinata"
SNAPSHOT_TS_MS = 1618790418000
SNAPSHOT_POS = 0

LABEL_COLUMN = "Action"


def catalog_types(catalog: DataFrame, rules: TypeRules = TypeRules()) -> DataFrame:
    """(database, table, column, data_type) plus the Spark type and whether the type was known."""
    has_precision = {"precision", "scale"} <= set(catalog.columns)
    precision, scale = (F.col("precision"), F.col("scale")) if has_precision else (None, None)
    mapped = spark_type(F.col("data_type"), rules, precision, scale)
    final = override_type(F.col("database"), F.col("table"), F.col("column"), mapped, rules)
    return catalog.withColumns(
        {"spark_type": final, "known": F.coalesce(known_type(F.col("data_type")), F.lit(False))}
    )


def unknown_types(typed_catalog: DataFrame) -> DataFrame:
    """Catalog columns kept as text because their type has no rule: the data-quality report."""
    return typed_catalog.filter(~F.col("known"))


def type_maps(typed_catalog: DataFrame) -> DataFrame:
    """One row per table: column name -> Spark type."""
    entries = F.sort_array(F.collect_list(F.struct("column", "spark_type")))
    return typed_catalog.groupBy("database", "table").agg(
        F.map_from_entries(entries).alias("types")
    )


def flatten_row(events: DataFrame, columns: Sequence[str], values: str = "values") -> DataFrame:
    """The named values as text columns; a value the event does not carry is null."""
    rest = [c for c in events.columns if c != values]
    return events.select(*rest, *[F.col(values)[c].alias(c) for c in columns])


EVENT_KEEP = ("date_action", "log_position")


def row_column(name: str, keep: Sequence[str] = EVENT_KEEP) -> str:
    """Name a source column gets beside the kept and bookkeeping columns."""
    return f"row_{name}" if name in {*keep, LABEL_COLUMN, *BOOKKEEPING} else name


def typed_events(
    events: DataFrame,
    columns: Sequence[tuple[str, str]],
    label: str = STREAM_LABEL,
    keep: Sequence[str] = EVENT_KEEP,
    values: str = "values",
    lost: str | None = None,
    rest: str | None = None,
) -> DataFrame:
    """Events of one table as typed rows.

    ``lost`` names a further column with the number of the row's values that its types don't take, ``rest`` one with the
    fields that the catalog lacks, as JSON text (for values that are text themselves).

    The values live apart until here, so source columns called ``table`` or ``schema`` cannot
    collide with the envelope. One that is called like a kept or a bookkeeping column comes out
    as ``row_<name>``.
    """
    held = F.col(values)
    if isinstance(events.schema[values].dataType, T.StringType):
        # taken apart inside a generator, so that no filter above parses the text again
        fields = T.StructType([T.StructField(c, T.StringType()) for c, _ in columns])
        parsed = F.explode(F.array(F.from_json(held, fields)))
        events = events.select("*", parsed.alias("_parsed"))
        held = F.col("_parsed")
    typed = [safe_cast(held[c], t) for c, t in columns]
    named = [v.alias(row_column(c, keep)) for v, (c, _) in zip(typed, columns)]
    if lost is not None:
        gone = [(held[c].isNotNull() & v.isNull()).cast("int") for v, (c, _) in zip(typed, columns)]
        named.append(reduce(Column.__add__, gone, F.lit(0)).alias(lost))
    if rest is not None:
        named.append(unlisted_fields(F.col(values), [c for c, _ in columns]).alias(rest))
    return events.select(*named, *keep, F.lit(label).alias(LABEL_COLUMN))


def typed_columns(
    rows: DataFrame, columns: Sequence[tuple[str, str]], label: str | None = None
) -> DataFrame:
    """The same for rows that already have columns (snapshots, daily files).

    Columns without a catalog entry stay as they are; catalog columns the file lacks become null.
    """
    wanted = dict(columns)
    have = {f.name: f.dataType for f in rows.schema}
    out = [
        safe_cast(F.col(f"`{n}`"), wanted[n], t).alias(n) if n in wanted else F.col(f"`{n}`")
        for n, t in have.items()
    ]
    out += [F.lit(None).cast(t).alias(n) for n, t in columns if n not in have]
    if label is not None:
        out.append(F.lit(label).alias(LABEL_COLUMN))
    return rows.select(*out)


def null_fill(rows: DataFrame) -> DataFrame:
    """0 for numeric columns and '' for text columns; dates, times and booleans stay null."""
    return rows.na.fill(0).na.fill("")


def stamp_snapshot(rows: DataFrame, table: str, ts_ms: int = SNAPSHOT_TS_MS) -> DataFrame:
    """Change metadata for snapshot rows; the time is a number, so it compares with change rows."""
    return rows.withColumns(
        {
            "__op": F.lit(SNAPSHOT_OP),
            "__table": F.lit(table),
            "__source_ts_ms": F.lit(ts_ms).cast(T.LongType()),
            "__source_pos": F.lit(SNAPSHOT_POS).cast(T.LongType()),
        }
    )


def cast_failures(events: DataFrame, columns: Sequence[tuple[str, str]], values: str = "values") -> DataFrame:
    """Per column: values present in the event whose typed form is null."""
    counts = [
        F.count_if(F.col(values)[c].isNotNull() & safe_cast(F.col(values)[c], t).isNull()).alias(c)
        for c, t in columns
    ]
    wide = events.agg(*counts)
    return wide.unpivot([], [F.col(f"`{c}`") for c, _ in columns], "column", "n_failed")
