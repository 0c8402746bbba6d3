"""Changes of many small tables typed, reduced and written by one job, then handed to their tables folder by folder."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import files
from rowtide.frames import small_frame
from rowtide.functions.casting import safe_cast
from rowtide.functions.keys import any_null, bucket_of
from rowtide.operators.events import DELETE, SIDE, tag_binlog
from rowtide.operators.latest import latest_per_key
from rowtide.operators.merge import precedence
from rowtide.operators.typed import LABEL_COLUMN, STREAM_LABEL, row_column
from rowtide.plans.tables import for_each
from rowtide.sinks.table import LakeTable
from rowtide.spec import BATCH, BUCKET, DELETED, STREAM_ORDER

# A job types the columns of all its tables side by side; beyond so many columns there is a further job.
MAX_COLUMNS = 400

_SLOT = "_slot"
_KEY = "_key"
_LOST = "_lost"


@dataclass
class SmallTable:
    """A table of the batch: its lake table (whose spec has the stored key names) and its catalog columns."""

    lake: LakeTable
    columns: list[tuple[str, str]]

    @property
    def name(self) -> tuple[str, str]:
        return self.lake.spec.database, self.lake.spec.table


def groups(tables: Sequence[SmallTable], keep: Sequence[str], limit: int = MAX_COLUMNS) -> list[list[SmallTable]]:
    """Tables that can share a job: no column name of two types, no two key or policy rules, at most ``limit`` columns."""
    out: list[tuple[dict[str, str], list[SmallTable]]] = []
    for table in sorted(tables, key=lambda t: t.name):
        mine = {row_column(c, keep): t for c, t in table.columns}
        for held, members in out:
            if len(held | mine) <= limit and all(held.get(c, t) == t for c, t in mine.items()) and members[0].lake.spec.policy == table.lake.spec.policy:
                held |= mine
                members.append(table)
                break
        else:
            out.append((dict(mine), [table]))
    return [members for _, members in out]


def _by_slot(choices: dict[int, object], value) -> Column:
    """``value(x)`` where the slot is one of those with choice ``x``."""
    slots: dict[object, list[int]] = {}
    for slot, x in choices.items():
        slots.setdefault(x, []).append(slot)
    parts = [F.when(F.col(_SLOT).isin(held), value(x)) for x, held in slots.items()]
    return F.coalesce(*parts)


def typed_together(staged: DataFrame, tables: Sequence[SmallTable], extras: Sequence[str] = (), label: str = STREAM_LABEL, batch: int = 0) -> DataFrame:
    """Staged events (``schema, table, values`` as JSON text) as change rows of all these tables, with every column of any.

    ``_slot`` is a table's place in the list, ``_key`` its key as text, ``_lost`` the number of values their types don't take.
    """
    keep = (*STREAM_ORDER, *extras, SIDE)
    kinds = {c: t for table in tables for c, t in table.columns}
    members = {c: [n for n, table in enumerate(tables) if c in dict(table.columns)] for c in kinds}
    names = small_frame(staged.sparkSession, [(n, *t.name) for n, t in enumerate(tables)], T.StructType([T.StructField(_SLOT, T.IntegerType()), T.StructField("_s", T.StringType()), T.StructField("_t", T.StringType())]))
    rows = tag_binlog(staged).join(names, (F.col("schema") == F.col("_s")) & (F.col("table") == F.col("_t")))
    # taken apart inside a generator, so that nothing above parses the text again
    fields = T.StructType([T.StructField(c, T.StringType()) for c in kinds])
    rows = rows.select(_SLOT, *keep, F.explode(F.array(F.from_json("values", fields))).alias("_parsed"))
    held = F.col("_parsed")

    def inside(c: str) -> Column:
        own = members[c]
        value = safe_cast(held[c], kinds[c])
        return value if len(own) == len(tables) else F.when(F.col(_SLOT).isin(own), value)

    lost = [(F.col(_SLOT).isin(members[c]) & held[c].isNotNull() & safe_cast(held[c], t).isNull()).cast("int") for c, t in kinds.items()]
    typed = rows.select(_SLOT, *[inside(c).alias(row_column(c, keep)) for c in sorted(kinds)], *keep, reduce(Column.__add__, lost).alias(_LOST))
    keys = {n: table.lake.spec.keys for n, table in enumerate(tables)}
    gone = F.col(SIDE) == DELETE

    def kept(c: str) -> Column:
        """A delete keeps its key and order columns and nothing else."""
        owners = [n for n, k in keys.items() if c in k]
        return F.when(~gone | F.col(_SLOT).isin(owners), F.col(f"`{c}`")).alias(c) if owners else F.when(~gone, F.col(f"`{c}`")).alias(c)

    plain = [c for c in typed.columns if c not in (_SLOT, _LOST, SIDE, *STREAM_ORDER)]
    out = typed.withColumn(_KEY, _by_slot(keys, lambda k: F.array(*[F.col(f"`{c}`").cast("string") for c in k])))
    return out.select(
        _SLOT, _KEY, _LOST, *[kept(c) for c in plain], *STREAM_ORDER, F.when(~gone, F.lit(label)).alias(LABEL_COLUMN),
        F.lit(batch).cast("bigint").alias(BATCH), gone.alias(DELETED),
    )


def null_key() -> Column:
    return F.exists(_KEY, lambda x: x.isNull())


def merge_together(spark: SparkSession, staged: DataFrame, tables: Sequence[SmallTable], path: str, extras: Sequence[str] = (), label: str = STREAM_LABEL, batch: int = 0) -> dict:
    """Merge the staged events of these tables (one of ``groups``) with one write; ``path`` is a folder for it.

    Returns what the pass has counted: rows without a key, and values lost to casts. Written rows are moved into each
    table's folder of changes and count once that is marked complete; a batch that is cut short is repeated whole.
    """
    typed = typed_together(staged, tables, extras, label, batch)
    seen = Observation()
    typed = typed.observe(seen, F.count_if(null_key()).alias("keyless"), F.sum(_LOST).alias("lost"))
    policy = tables[0].lake.spec.policy
    changes = typed.filter(~null_key()).drop(_LOST)
    # ties fall to the remaining columns, as in a merge of one table
    newest = latest_per_key(changes, [_SLOT, _KEY], precedence(policy, STREAM_ORDER)).drop(_KEY)
    layouts = {n: (t.lake.spec.keys, t.lake.placement()) for n, t in enumerate(tables)}
    placed = newest.withColumn(BUCKET, _by_slot(layouts, lambda x: bucket_of(x[0], x[1])))
    files.delete(spark, path)
    ordered = placed.hint("rebalance", _SLOT).sortWithinPartitions(_SLOT, BUCKET)
    ordered.write.mode("overwrite").partitionBy(_SLOT).parquet(path)
    types = {f.name: f for f in placed.schema}
    written = {int(n.partition("=")[2]) for n in files.child_names(spark, path) if n.startswith(f"{_SLOT}=")}

    def hand_over(n: int) -> None:
        table = tables[n]
        names = [row_column(c, (*STREAM_ORDER, *extras, SIDE)) for c, _ in table.columns]
        order = [*names, *STREAM_ORDER, *extras, LABEL_COLUMN, BATCH, DELETED, BUCKET]
        table.lake.adopt(f"{path}/{_SLOT}={n}", T.StructType([types[c] for c in order]), batch)

    errors = [error for _, _, error in for_each(spark, sorted(written), hand_over) if error is not None]
    if errors:
        raise errors[0]
    files.delete(spark, path)
    return seen.get
