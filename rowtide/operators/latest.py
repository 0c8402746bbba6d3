"""Latest row per key, change-log order, previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "_rank"
_UNORDERED = (T.MapType, T.VariantType)


def _sortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_sortable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _sortable(dtype.elementType)
    return not isinstance(dtype, _UNORDERED)


def ranking_columns(schema: T.StructType, group: Sequence[str], order: Sequence[str]) -> list[str]:
    """``order`` first, then every other column that can be sorted, so that reruns agree."""
    return [*order, *[f.name for f in schema if f.name not in {*group, *order} and _sortable(f.dataType)]]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], within: Sequence[str] = ()
) -> DataFrame:
    """The row with the greatest ``order`` per key; nulls lowest, ties by the remaining columns.

    Rank 1 over a window plans to a group limit on both sides of the exchange: each map task
    sends at most one row per key, however many rows a hot key has. ``within`` names columns
    the key determines and the input is already partitioned by, which saves the exchange.
    """
    group = [*within, *keys]
    ranking = [F.col(c).desc_nulls_last() for c in ranking_columns(df.schema, group, order)]
    window = Window.partitionBy(*group).orderBy(*ranking)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def ordered_changes(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """The change log in order, for readers. A merge needs no sort and never calls this."""
    return df.orderBy(*[F.col(c).asc() for c in order])


def preview_topn(df: DataFrame, columns: Sequence[str], order: Sequence[str], n: int = 10) -> DataFrame:
    return df.orderBy(*[F.col(c).asc() for c in order]).select(*columns).limit(n)
