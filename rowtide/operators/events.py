"""Row-change events: parse, classify, route, split by operation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions.casting import text_to_long, text_to_time
from rowtide.schemas import CORRUPT, VALUES_MAP, envelope

# Operation names of the two change formats.
BINLOG_DELETE = "DeleteRowsEvent"
DEBEZIUM_UPSERTS = ("c", "u")
DEBEZIUM_DELETES = ("d",)
SNAPSHOT_OP = "s"

SIDE = "_side"
REASON = "_reason"
UPSERT, DELETE, REJECT = "upsert", "delete", "reject"


def decode(raw: DataFrame, value: str = "value") -> DataFrame:
    return raw.withColumn(value, F.col(value).cast("string"))


def parse_events(
    raw: DataFrame,
    value: str = "value",
    time_type: str = "timestamp",
    extras: Sequence[str] = (),
    values: T.DataType = VALUES_MAP,
    time_unit: str = "ms",
) -> DataFrame:
    """One row per event, with the text it came from and the reason if it cannot be applied.

    A text may hold one event or an array of events. Nothing is dropped: what does not parse
    comes out with ``_reason`` set. ``extras`` names further top-level fields to keep, as text.
    ``values`` is a map, or STRING to leave the row's JSON object as it is for ``typed_events``:
    smaller to store, and cheaper to take apart once the columns of its table are known.
    ``time_unit`` is what a bare number in ``date_action`` counts (``casting.TIME_UNITS``).
    """
    layout = envelope(values, extras)
    text = F.col(value)
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    many = F.when(text.rlike(r"^\s*\["), F.from_json(text, "array<string>"))
    # Parsed inside the generator: a filter on the result cannot be pushed below it, where
    # it would parse the text once more for every field it looks at.
    parsed = F.transform(
        F.coalesce(many, F.array(text)),
        lambda one: F.struct(one.alias("_one"), F.from_json(one, layout, opts).alias("_e")),
    )
    keep = [c for c in raw.columns if c != value]
    events = decode(raw, value).select(*keep, text.alias("_whole"), F.inline_outer(parsed))
    e = F.col("_e")
    when = text_to_time(e["date_action"], time_type, time_unit)
    return events.select(
        *keep,
        e["schema"].alias("schema"),
        e["table"].alias("table"),
        e["log_type"].alias("log_type"),
        when.alias("date_action"),
        text_to_long(e["log_position"]).alias("log_position"),
        e["row"]["values"].alias("values"),
        *[e[c].alias(c) for c in extras],
        F.coalesce("_one", "_whole").alias(value),
        _reason(e, F.col("_one"), values, when).alias(REASON),
    )


def _reason(e: Column, one: Column, values: T.DataType, when: Column) -> Column:
    broken = one.isNull() | e[CORRUPT].isNotNull()
    if isinstance(values, T.StringType):
        broken = broken | ~e["row"]["values"].startswith("{")
    return (
        F.when(broken, "malformed_json")
        .when((F.coalesce(e["schema"], F.lit("")) == "") | (F.coalesce(e["table"], F.lit("")) == ""), "no_table")
        .when(e["log_type"].isNull(), "no_operation")
        .when(e["row"]["values"].isNull(), "no_values")
        .when(e["date_action"].isNotNull() & when.isNull(), "bad_time")
    )


def accepted(events: DataFrame) -> DataFrame:
    return events.filter(F.col(REASON).isNull())


def rejected(events: DataFrame) -> DataFrame:
    return events.filter(F.col(REASON).isNotNull())


def route_table(events: DataFrame, schema: str, table: str) -> DataFrame:
    return events.filter((F.col("table") == table) & (F.col("schema") == schema))


def distinct_tables(events: DataFrame) -> DataFrame:
    return events.select("schema", "table").dropDuplicates(["schema", "table"])


def tag_binlog(events: DataFrame, op: str = "log_type") -> DataFrame:
    """Every operation but the delete is an upsert; a missing one is neither."""
    side = F.when(F.col(op).isNull(), REJECT).when(F.col(op) == BINLOG_DELETE, DELETE)
    return events.withColumn(SIDE, side.otherwise(UPSERT))


def tag_debezium(
    changes: DataFrame,
    op: str = "__op",
    upserts: Sequence[str] = DEBEZIUM_UPSERTS,
    deletes: Sequence[str] = DEBEZIUM_DELETES,
) -> DataFrame:
    """Only the listed operations are applied; ``upserts`` may be widened, e.g. by snapshot reads."""
    side = F.when(F.col(op).isin(*upserts), UPSERT).when(F.col(op).isin(*deletes), DELETE)
    return changes.withColumn(SIDE, side.otherwise(REJECT))


def split_ops(tagged: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(upserts, deletes, rejected). The engine itself keeps both sides in one frame and one pass."""
    return tuple(tagged.filter(F.col(SIDE) == s).drop(SIDE) for s in (UPSERT, DELETE, REJECT))


def batch_counts(tagged: DataFrame, by: Sequence[str] = ("schema", "table")) -> DataFrame:
    """Rows, upserts and deletes per group in one aggregation; a count of 0 is the emptiness test."""
    def count(side: str) -> Column:
        return F.count_if(F.col(SIDE) == side)

    return tagged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        count(UPSERT).alias("n_upserts"),
        count(DELETE).alias("n_deletes"),
        count(REJECT).alias("n_rejected"),
    )
