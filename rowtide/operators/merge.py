"""Merge of stored rows and changes by record key, as a pure DataFrame operation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.operators.events import DELETE, REJECT, SIDE
from rowtide.operators.latest import latest_per_key, ranking_columns
from rowtide.spec import ARRIVAL, BATCH, BOOKKEEPING, BUCKET, DELETED, EVENT_ORDER


def precedence(policy: str, order: Sequence[str]) -> tuple[str, ...]:
    """Columns whose greatest value names the surviving row of a key.

    event_order: the latest change by (time, position), whatever batch brought it.
    arrival: the latest batch that touches the key; in it any delete beats every upsert.
    Both are idempotent, so a replayed batch changes nothing.
    """
    if policy == EVENT_ORDER:
        return (*order, DELETED)
    if policy == ARRIVAL:
        return (BATCH, DELETED, *order)
    raise ValueError(f"unknown merge policy {policy!r}")


def as_changes(tagged: DataFrame, keys: Sequence[str], order: Sequence[str], batch: int | None = None) -> DataFrame:
    """Tagged rows to change rows. A delete keeps its key and order columns and nothing else."""
    gone = F.col(SIDE) == DELETE
    kept = {*keys, *order, BATCH}
    cols = [
        F.col(f"`{c}`") if c in kept else F.when(~gone, F.col(f"`{c}`")).alias(c)
        for c in tagged.columns
        if c != SIDE and not (c == BATCH and batch is not None)
    ]
    if batch is not None:
        cols.append(F.lit(batch).cast("bigint").alias(BATCH))
    return tagged.filter(F.col(SIDE) != REJECT).select(*cols, gone.alias(DELETED))


def reduce_changes(changes: DataFrame, keys: Sequence[str], order: Sequence[str], policy: str = EVENT_ORDER) -> DataFrame:
    return latest_per_key(changes, keys, precedence(policy, order))


def by_bucket(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows moved by bucket number; with as many tasks as buckets, each task gets just one."""
    return rows.repartitionById(tasks, BUCKET)


def merge(
    stored: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    policy: str = EVENT_ORDER,
    tasks: int | None = None,
) -> DataFrame:
    """Surviving row per key over stored rows and changes, tombstones included.

    One union and one window: stored rows cross the network once, whatever the share of
    changed keys. With ``tasks`` both sides carry the bucket of their key and are moved by
    bucket; that one exchange serves the window and the bucketed write. Changes must be reduced
    to one row per key first (``reduce_changes``), so no bucket is hot.
    """
    both = stored.unionByName(changes, allowMissingColumns=True)
    if tasks is None:
        return latest_per_key(both, keys, precedence(policy, order))
    # the window over (bucket, key) needs no exchange beyond the one by bucket
    return latest_per_key(by_bucket(both, tasks), keys, precedence(policy, order), within=[BUCKET])


_THEIRS = "_theirs"
_MINE = "_mine"


def overlay(stored: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], small: bool = False) -> DataFrame:
    """Stored rows (one per key) under the changes since then, tombstones included; stored rows need no exchange.

    The changes alone are reduced to one row per key. A stored row stays unless a change of its key is at least its equal
    in ``order`` and, where that ties, in the remaining columns; a change stays unless a stored row beats it. So the
    stored rows are only matched with keys: as long as the reduced changes are broadcast (Spark decides by their size;
    ``small`` says that the caller has checked it), no stored row is shuffled, and filters on stored columns reach its
    scan. What changes are compared with is read again, but only its key and order columns, and whole rows only for the
    keys that tie, if there are any.
    """
    newest = latest_per_key(changes, keys, order)
    both = T.StructType([f for f in stored.schema if f.name in newest.columns])
    named = {k: f"_key_{n}" for n, k in enumerate(keys)}
    hinted = F.broadcast if small else lambda frame: frame

    def rank(columns: Sequence[str]) -> Column:
        return F.struct(*[F.col(f"`{c}`") for c in columns])

    def keyed(frame: DataFrame, *more: Column) -> DataFrame:
        return frame.select(*[F.col(f"`{k}`").alias(n) for k, n in named.items()], *more)

    def same(other: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"`{k}`") == other[n] for k, n in named.items()])

    whole = rank(ranking_columns(both, keys, order))
    theirs, wanted = keyed(newest, whole.alias(_THEIRS)), keyed(newest)
    beside = stored.join(hinted(theirs), same(theirs), "left")
    unbeaten = beside.filter(F.col(_THEIRS).isNull() | (whole > F.col(_THEIRS))).select(*stored.columns)
    met = keyed(stored.join(hinted(wanted), same(wanted), "left_semi"), rank(order).alias(_MINE))
    judged = newest.join(met, same(met), "left")
    winning = judged.filter(F.col(_MINE).isNull() | (rank(order) > F.col(_MINE))).select(*newest.columns)
    tied = judged.filter(rank(order) == F.col(_MINE)).select(*newest.columns)
    open_keys = keyed(tied)
    equals = keyed(stored.join(hinted(open_keys), same(open_keys), "left_semi"), whole.alias(_MINE))
    settled = tied.join(equals, same(equals)).filter(whole >= F.col(_MINE)).select(*newest.columns)
    out = unbeaten.unionByName(winning, allowMissingColumns=True)
    return out.unionByName(settled, allowMissingColumns=True)


def visible(rows: DataFrame) -> DataFrame:
    """What a reader sees: no tombstones, no bookkeeping."""
    return rows.filter(~F.col(DELETED)).drop(*BOOKKEEPING)


def upsert_rows(stored: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plain upsert where every incoming row replaces the stored row of its key."""
    kept = delete_rows(stored, changes, keys)
    return kept.unionByName(changes, allowMissingColumns=True)


def delete_rows(stored: DataFrame, deleted_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys are made distinct before the join: partial aggregation shrinks a hot key on the map
    side, and its exchange is the one the join needs anyway."""
    gone = deleted_keys.select(*keys).distinct()
    return stored.join(gone, list(keys), "left_anti").select(*stored.columns)
