"""Keyed lake table: loaded rows in hash buckets, and the changes since, as folders that are only ever added."""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide import files
from rowtide.functions.casting import safe_cast
from rowtide.functions.keys import any_null, with_bucket
from rowtide.operators.latest import latest_per_key, ranking_columns
from rowtide.operators.merge import overlay, precedence, reduce_changes, visible
from rowtide.spec import BATCH, BUCKET, DELETED, TableSpec, buckets_for

# Fixed value: consumers find database ``shop`` in the catalog under this prefix.
DATABASE_PREFIX = "hudi_"

MERGE = "_merge"
BROADCAST_BYTES = 32 << 20  # change files up to this size are broadcast when laid over the rows
MAX_PARTS = 8
DONE = "_SUCCESS"  # what Spark's committer leaves in a folder whose job has ended


class LakeTable:
    """One table below ``root/tables``.

    g<n>/layout-<k>.json  key, bucket count, schema and where each bucket's rows lie; the greatest k counts
    g<n>/rows/_bucket=b/  the buckets that load or compaction number n wrote, tombstones included
    g<n>/changes/_merge=<id>/  the reduced changes of a merge since then, sorted by bucket and key

    A merge adds a folder of changes and touches nothing else. The surviving row per key is found on reading: the changes
    are reduced alone and laid over the rows. ``compact`` writes that down for the buckets that have changes, as the next
    generation; its layout says which older generations hold the other buckets. The greatest generation whose rows are
    complete counts, and of its changes the complete ones, so wherever a driver stops, readers have the old state or the
    new one. A merge that is cut short is repeated by its caller and gives the same rows.
    """

    def __init__(self, spark: SparkSession, root: str, spec: TableSpec):
        self.spark = spark
        self.spec = spec
        self.root = f"{root.rstrip('/')}/tables/{spec.database}/{spec.table}"
        self._shown: tuple | None = None  # what the catalog shows, as far as this object knows
        self._layout: tuple[int, dict] | None = None

    # ---- what is there

    @property
    def generation(self) -> int:
        """0: nothing stored yet."""
        numbers = sorted((int(n[1:]) for n in files.child_names(self.spark, self.root) if n[1:].isdigit()), reverse=True)
        return next((n for n in numbers if files.exists(self.spark, f"{self._folder(n)}/rows/{DONE}")), 0)

    def _folder(self, generation: int) -> str:
        return f"{self.root}/g{generation}"

    def change_folders(self, generation: int | None = None) -> list[str]:
        base = f"{self._folder(generation or self.generation)}/changes"
        found = [f"{base}/{n}" for n in sorted(files.child_names(self.spark, base))]
        return [f for f in found if files.exists(self.spark, f"{f}/{DONE}")]

    def layout(self, generation: int | None = None) -> dict | None:
        generation = generation or self.generation
        if not generation:
            return None
        if self._layout is None or self._layout[0] != generation:
            folder = self._folder(generation)
            last = max(int(n[7:-5]) for n in files.child_names(self.spark, folder) if n.startswith("layout-") and n.endswith(".json"))
            self._layout = (generation, json.loads(files.read_text(self.spark, f"{folder}/layout-{last}.json")) | {"number": last})
        return self._layout[1]

    def _keep_layout(self, generation: int, schema: T.StructType, buckets: int, number: int = 0, older: dict[int, list[int]] | None = None) -> None:
        """``older``: buckets whose rows an older generation holds."""
        fields = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        layout = {"keys": list(self.spec.keys), "buckets": buckets, "schema": fields.jsonValue()}
        layout["older"] = {str(g): _ranges(held) for g, held in (older or {}).items()}
        files.write_new(self.spark, f"{self._folder(generation)}/layout-{number}.json", json.dumps(layout))
        self._layout = None

    @property
    def schema(self) -> T.StructType | None:
        """Schema of the stored rows; kept beside them because old folders may lack new columns."""
        layout = self.layout()
        return T.StructType.fromJson(layout["schema"]) if layout else None

    @property
    def buckets(self) -> int | None:
        layout = self.layout()
        return layout["buckets"] if layout else self.spec.buckets

    def _checked(self, generation: int) -> dict:
        """The stored layout; another key or bucket count would put a key's rows in two places."""
        layout = self.layout(generation)
        wanted = self.spec.buckets or layout["buckets"]
        if layout["keys"] != list(self.spec.keys) or layout["buckets"] != wanted:
            raise ValueError(f"{self.root} is laid out by {layout['keys']} in {layout['buckets']} buckets, not {list(self.spec.keys)} in {wanted}; load or compact it anew to change that")
        return layout

    # ---- reading

    def _parts(self, generation: int) -> dict[int, list[int] | None]:
        """Generations that hold rows, with the buckets that count there (None: all they have)."""
        return {generation: None} | {int(g): _numbers(held) for g, held in self.layout(generation)["older"].items()}

    def _base(self, generation: int) -> DataFrame:
        out = []
        for part, held in self._parts(generation).items():
            rows = self.spark.read.schema(self.schema).parquet(f"{self._folder(part)}/rows")
            out.append(rows if held is None else rows.filter(_in_buckets(held)))
        return reduce(DataFrame.unionByName, out)

    def _changes(self, folders: list[str]) -> DataFrame:
        # a folder per merge, and no partition among its columns
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*folders)

    def _touched(self, folders: list[str]) -> list[int]:
        """Buckets with changes: one column of the change files, at most the number of buckets."""
        return sorted(r[0] for r in self._changes(folders).select(BUCKET).distinct().collect())

    def rows(self, buckets: list[int] | None = None) -> DataFrame | None:
        """One row per key, tombstones included; other buckets than the given ones are pruned."""
        generation = self.generation
        if not generation:
            return None
        base, folders = self._base(generation), self.change_folders(generation)
        changes = self._changes(folders) if folders else None
        if changes is not None and not self._has_rows(generation):
            # nothing but changes yet; those of one merge are reduced
            changes = changes if buckets is None else changes.filter(_in_buckets(buckets))
            return changes if len(folders) == 1 else latest_per_key(changes, self.spec.keys, self._precedence(changes.columns))
        if buckets is not None:
            base, changes = (x and x.filter(_in_buckets(buckets)) for x in (base, changes))
        if changes is None:
            return base
        small = sum(files.size(self.spark, f) for f in folders) <= BROADCAST_BYTES
        if small:
            return self._overlay(base, changes, small)
        # Changes that may be shuffled with the rows: only with those of their buckets.
        inside = _in_buckets(self._touched(folders))
        return base.filter(~inside).unionByName(self._overlay(base.filter(inside), changes))

    def _overlay(self, base: DataFrame, changes: DataFrame, small: bool = False) -> DataFrame:
        return overlay(base, changes, self.spec.keys, self._precedence(base.columns), small)

    def _precedence(self, columns: list[str]) -> list[str]:
        """A table that has only been loaded may lack the order columns of its changes."""
        return [c for c in precedence(self.spec.policy, self.spec.order) if c in columns]

    def read(self) -> DataFrame:
        return visible(self.rows())

    # ---- writing

    def bulk_load(self, rows: DataFrame, batch: int = 0, unique: bool = False) -> None:
        """Replace the table by a snapshot; of rows that repeat a key the last in order stays.

        ``unique`` promises one row per key and saves the reduction. The old generation stays for
        those who still read it (``rows`` may be one of them) until the next one is written.
        """
        stored = rows.withColumns({BATCH: F.lit(batch).cast("bigint"), DELETED: F.lit(False)})
        if not unique:
            stored = latest_per_key(stored, self.spec.keys, self._precedence(stored.columns))
        self._new_generation(stored, self.spec.buckets or buckets_for(_plan_bytes(rows)))

    def _new_generation(self, rows: DataFrame, buckets: int) -> None:
        """Write the rows (without buckets) as the next generation; older ones than the last go."""
        placed = with_bucket(rows, self.spec.keys, buckets)
        now = self._free_generation()
        self._keep_layout(now, placed.schema, buckets)
        # rebalance: one shuffle with a partition per bucket, of which AQE cuts those that are too
        # big for one task and joins those that are too small for one
        _write(placed.hint("rebalance", buckets, BUCKET), f"{self._folder(now)}/rows")
        self._drop_old(now)

    def _free_generation(self) -> int:
        """The next number; what an unfinished writer left under it goes."""
        now = self.generation + 1
        files.delete(self.spark, self._folder(now))
        return now

    def _drop_old(self, now: int) -> None:
        """What neither this generation nor the one before it (which somebody may be reading) needs goes."""
        numbers = [int(n[1:]) for n in files.child_names(self.spark, self.root) if n[1:].isdigit()]
        before = [n for n in numbers if n < now and files.exists(self.spark, f"{self._folder(n)}/rows/{DONE}")]
        needed: dict[int, set[int] | None] = {}
        for reader in [now, *sorted(before)[-1:]]:
            for part, held in self._parts(reader).items():
                known = needed.get(part, set())
                needed[part] = None if held is None or known is None else known | set(held)
        self._layout = None
        for n in numbers:
            if n >= now or needed.get(n, set()) is None:
                continue
            if n not in needed:
                files.delete(self.spark, self._folder(n))
                continue
            for name in _bucket_names(self.spark, f"{self._folder(n)}/rows"):
                if int(name.partition("=")[2]) not in needed[n]:
                    files.delete(self.spark, f"{self._folder(n)}/rows/{name}")

    def merge(self, changes: DataFrame, batch: int = 0) -> int:
        """Add change rows (``operators.merge.as_changes``); returns the number of buckets they touch.

        k changed keys are k rows written. The first merge of a new table writes its first generation.
        """
        keys, order, policy = self.spec.keys, self.spec.order, self.spec.policy
        if BATCH not in changes.columns:
            changes = changes.withColumn(BATCH, F.lit(batch).cast("bigint"))
        reduced = reduce_changes(changes.filter(~any_null(keys)), keys, order, policy)
        generation = self.generation
        if not generation:
            buckets = self.spec.buckets or buckets_for(_plan_bytes(changes))
            now = self._free_generation()
            self._keep_layout(now, with_bucket(reduced, keys, buckets).schema, buckets)
            _write(with_bucket(reduced, keys, buckets).hint("rebalance", BUCKET), f"{self._folder(now)}/rows")
            touched = _bucket_names(self.spark, f"{self._folder(now)}/rows")
            if not touched:  # no row: the table is still to come
                files.delete(self.spark, self._folder(now))
                self._layout = None
            return len(touched)
        layout = self._checked(generation)
        placed = with_bucket(reduced, keys, layout["buckets"])
        stored, now = self.schema, {f.name: f.dataType for f in placed.schema}
        if any(now.get(f.name, f.dataType) != f.dataType for f in stored):
            return self._merge_retyped(placed, layout["buckets"], now)
        self._add_columns(generation, placed.schema)
        path = f"{self._folder(generation)}/changes/{MERGE}={batch:012d}-{uuid.uuid4().hex}"
        met = Observation()
        # files in proportion to the bytes; sorted, so that their statistics tell which buckets and keys they hold
        sorted_rows = placed.observe(met, F.collect_set(BUCKET).alias("buckets")).hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *keys)
        _write_changes(sorted_rows, path)
        touched = met.get["buckets"] or []
        if not touched:
            files.delete(self.spark, path)
        return len(touched)

    def placement(self) -> int:
        """The number of buckets that adopted changes must be dealt by."""
        generation = self.generation
        return self._checked(generation)["buckets"] if generation else self.spec.buckets or 1

    def takes(self, types: dict[str, str]) -> bool:
        """Whether changes with these column types can be added without writing stored rows anew."""
        stored = {f.name: f.dataType.simpleString() for f in self.schema or []}
        return all(stored.get(c, t) == t for c, t in types.items())

    def adopt(self, folder: str, schema: T.StructType, batch: int) -> None:
        """Add a folder of change rows that another job has written: reduced, with the buckets of ``placement``.

        The folder is moved to its place and counts from when it is marked complete. A table that isn't there yet begins
        with a generation without rows.
        """
        generation = self.generation
        if not generation:
            generation = self._free_generation()
            self._keep_layout(generation, schema, self.spec.buckets or 1)
            files.make_folder(self.spark, f"{self._folder(generation)}/rows")
            files.write_new(self.spark, f"{self._folder(generation)}/rows/{DONE}", "")
        elif not self.takes({f.name: f.dataType.simpleString() for f in schema}):
            raise ValueError(f"{self.root} stores other column types than {schema.simpleString()}")
        else:
            self._add_columns(generation, schema)
        target = f"{self._folder(generation)}/changes/{MERGE}={batch:012d}-{uuid.uuid4().hex}"
        files.move(self.spark, folder, target)
        files.write_new(self.spark, f"{target}/{DONE}", "")

    def _add_columns(self, generation: int, schema: T.StructType) -> None:
        stored, layout = self.schema, self.layout(generation)
        fresh = [f for f in schema if f.name not in stored.names]
        if fresh:
            older = {g: held for g, held in self._parts(generation).items() if held is not None}
            self._keep_layout(generation, T.StructType([*stored.fields, *fresh]), layout["buckets"], layout["number"] + 1, older)

    def _merge_retyped(self, changes: DataFrame, buckets: int, now: dict[str, T.DataType]) -> int:
        """Columns whose source type has changed: all rows go into a generation of the new types."""
        retyped = {f.name: now[f.name] for f in self.schema if now.get(f.name, f.dataType) != f.dataType}
        stored = _retype(self.rows(), retyped)
        merged = self._overlay(stored, changes)
        self._write_merged(merged.select(*[f"`{c}`" for c in merged.columns if c != BUCKET], BUCKET), buckets)
        return buckets

    def _write_merged(self, merged: DataFrame, buckets: int, older: dict[int, list[int]] | None = None, tasks: int | None = None) -> None:
        now = self._free_generation()
        self._keep_layout(now, merged.schema, buckets, older=older)
        _write(merged.hint("rebalance", tasks or buckets, BUCKET), f"{self._folder(now)}/rows")
        self._drop_old(now)

    def compact(self, buckets: int | None = None, drop: Column | None = None) -> bool:
        """Write rows and changes down as a generation; returns whether there was anything to do.

        Only buckets that have changes (or rows to ``drop``) are read, shuffled once by bucket, and written; the others
        stay where they are. ``buckets`` deals all rows anew; without a number in the spec the stored bytes decide. After
        ``MAX_PARTS`` generations a compaction takes all buckets together again.
        """
        generation = self.generation
        if not generation:
            return False
        folders, layout = self.change_folders(generation), self.layout(generation)
        parts = self._parts(generation)
        stored = sum(files.size(self.spark, self._folder(g)) for g in parts)
        wanted = buckets or self.spec.buckets or max(layout["buckets"], buckets_for(stored))
        if not folders and drop is None and wanted == layout["buckets"]:
            return False
        rows = self.rows()
        if drop is not None:
            doomed = {r[0] for r in rows.filter(drop).select(BUCKET).distinct().collect()}
            rows = rows.filter(~drop)
        if wanted != layout["buckets"]:
            self._write_merged(with_bucket(rows.drop(BUCKET), self.spec.keys, wanted), wanted)
            return True
        touched = set(self._touched(folders)) if folders else set()
        touched |= doomed if drop is not None else set()
        if not touched:
            return False
        older = {g: [b for b in (held if held is not None else self._own_buckets(g)) if b not in touched] for g, held in parts.items()}
        older = {g: held for g, held in older.items() if held}
        if len(older) >= MAX_PARTS:
            older, touched = {}, None
        inside = rows if touched is None else rows.filter(_in_buckets(sorted(touched)))
        self._write_merged(inside, wanted, older, wanted if touched is None else len(touched))
        return True

    def _has_rows(self, generation: int) -> bool:
        """A table that began with adopted changes has none before its first compaction."""
        return len(self._parts(generation)) > 1 or bool(self._own_buckets(generation))

    def _own_buckets(self, generation: int) -> list[int]:
        """Buckets that a generation has written itself."""
        return sorted(int(n.partition("=")[2]) for n in _bucket_names(self.spark, f"{self._folder(generation)}/rows"))

    def purge_tombstones(self, before) -> None:
        """Compact without the tombstones whose first order column is below ``before``."""
        old = F.col(DELETED) & (F.col(self.spec.order[0]) < F.lit(before))
        self.compact(drop=F.coalesce(old, F.lit(False)))

    def next_batch(self) -> int:
        """A batch number above every one stored so far, for callers without their own."""
        generation = self.generation
        if not generation:
            return 1
        folders = self.change_folders(generation)
        stored = self._base(generation).select(BATCH)
        if folders:
            stored = stored.union(self._changes(folders).select(BATCH))
        return (stored.agg(F.max(BATCH)).first()[0] or 0) + 1

    # ---- catalog

    def register(self, prefix: str = DATABASE_PREFIX) -> str:
        """``<prefix><database>.<table>`` as a view of the live rows.

        Call it after every write. A new generation or schema makes the view anew; otherwise the
        session is only told that files have changed.
        """
        generation, database = self.generation, _quoted(prefix + self.spec.database)
        name = f"{database}.{_quoted(self.spec.table)}"
        changes = f"{database}.{_quoted(f'{self.spec.table}__changes')}"
        stored = self._parts(generation) if self._has_rows(generation) else {}
        parts = {f"{database}.{_quoted(f'{self.spec.table}__rows_{g}')}": (g, held) for g, held in stored.items()}
        state = (prefix, generation, self.schema.json())
        if self._shown != state:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
            fields = [f for f in self.schema if f.name != BUCKET]
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in [*fields, self.schema[BUCKET]])
            folder = f"{self._folder(generation)}/changes"
            files.make_folder(self.spark, folder)
            self._drop_tables(database)
            self.spark.sql(f"CREATE TABLE {changes} ({columns}) USING parquet OPTIONS (recursiveFileLookup 'true') LOCATION {_literal(folder)}")
            for part, (g, _) in parts.items():
                folder = f"{self._folder(g)}/rows"
                self.spark.sql(f"CREATE TABLE {part} ({columns}) USING parquet PARTITIONED BY ({BUCKET}) LOCATION {_literal(folder)}")
                self.spark.sql(f"MSCK REPAIR TABLE {part}")
            live = {part: held for part, (_, held) in parts.items()}
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {self._live_rows(live, changes, [f.name for f in fields])}")
            self._shown = state
        self.spark.sql(f"REFRESH TABLE {changes}")
        return name

    def _drop_tables(self, database: str) -> None:
        """The tables below the view, of whatever generations."""
        pattern = re.compile(re.escape(self.spec.table) + "__(changes|rows(_[0-9]+)?)", re.IGNORECASE)
        near = re.sub(r"[^0-9A-Za-z_]", ".", self.spec.table)
        for r in self.spark.sql(f"SHOW TABLES IN {database} LIKE {_literal(near + '__*')}").select("tableName").collect():
            if pattern.fullmatch(r[0]):
                self.spark.sql(f"DROP TABLE IF EXISTS {database}.{_quoted(r[0])}")

    def _live_rows(self, parts: dict[str, list[int] | None], changes: str, columns: list[str]) -> str:
        """``operators.merge.overlay`` as the text of a view: rows without a better change, and changes without a better row."""
        keys = [_quoted(k) for k in self.spec.keys]
        order = self._precedence(columns)
        ranking = ranking_columns(T.StructType([f for f in self.schema if f.name in columns]), self.spec.keys, order)
        newest_first = ", ".join(f"{_quoted(c)} DESC NULLS LAST" for c in ranking)
        names = ", ".join(map(_quoted, columns))

        def rank(side: str, by: list[str]) -> str:
            return "struct(" + ", ".join(f"{side}.{_quoted(c)}" for c in by) + ")"

        def same(other: str) -> str:
            return " AND ".join(f"r.{k} = {other}.{k}" for k in keys)

        def shown(side: str) -> str:
            return ", ".join(f"{side}.{_quoted(c)}" for c in columns if c not in (DELETED, BATCH))

        stored = " UNION ALL ".join(f"SELECT {names} FROM {part}" + ("" if held is None else f" WHERE {_bucket_sql(held)}") for part, held in parts.items())
        if not parts:
            ranked = f"SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {newest_first}) AS _rank FROM {changes} AS c"
            return f"SELECT {shown('c')} FROM ({ranked}) AS c WHERE _rank = 1 AND NOT {DELETED}"
        ranked = f"SELECT {names}, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {newest_first}) AS _rank FROM {changes}"
        return f"""
            WITH r AS ({stored}), c AS (SELECT {names} FROM ({ranked}) WHERE _rank = 1),
            met AS (SELECT {', '.join(f'r.{x}' for x in dict.fromkeys([*keys, *map(_quoted, order)]))} FROM r LEFT SEMI JOIN c ON {same('c')}),
            tied AS (SELECT c.* FROM c JOIN met AS r ON {same('c')} AND {rank('c', order)} = {rank('r', order)}),
            equals AS (SELECT r.* FROM r LEFT SEMI JOIN tied ON {same('tied')})
            SELECT {shown('r')} FROM r LEFT JOIN c ON {same('c')} WHERE NOT r.{DELETED} AND (c.{keys[0]} IS NULL OR {rank('r', ranking)} > {rank('c', ranking)})
            UNION ALL
            SELECT {shown('c')} FROM c LEFT JOIN met AS r ON {same('c')} WHERE NOT c.{DELETED} AND (r.{keys[0]} IS NULL OR {rank('c', order)} > {rank('r', order)})
            UNION ALL
            SELECT {shown('tied')} FROM tied JOIN equals AS r ON {same('tied')} WHERE NOT tied.{DELETED} AND {rank('tied', ranking)} >= {rank('r', ranking)}"""


def _write(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET).parquet(path)


def _write_changes(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").parquet(path)


def _ranges(numbers: list[int]) -> str:
    """Sorted numbers as text: ``0-3,7``."""
    out: list[list[int]] = []
    for n in sorted(numbers):
        if out and out[-1][1] == n - 1:
            out[-1][1] = n
        else:
            out.append([n, n])
    return ",".join(str(a) if a == b else f"{a}-{b}" for a, b in out)


def _numbers(text: str) -> list[int]:
    pairs = [p.partition("-") for p in text.split(",") if p]
    return [n for a, _, b in pairs for n in range(int(a), int(b or a) + 1)]


def _bucket_names(spark: SparkSession, path: str) -> list[str]:
    return [n for n in files.child_names(spark, path) if n.startswith(f"{BUCKET}=")]


def _plan_bytes(rows: DataFrame) -> int:
    """What the optimizer takes the rows' size to be: file sizes for a scan."""
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return min(int(str(size)), 1 << 60)


def _retype(stored: DataFrame, wanted: dict[str, T.DataType]) -> DataFrame:
    return stored.select(
        *[
            safe_cast(F.col(f"`{f.name}`"), wanted[f.name].simpleString(), f.dataType).alias(f.name)
            if f.name in wanted
            else F.col(f"`{f.name}`")
            for f in stored.schema
        ]
    )


def _in_buckets(buckets: list[int]) -> Column:
    return F.expr(_bucket_sql(buckets))


def _bucket_sql(buckets: list[int]) -> str:
    """Ranges of at least three numbers, and one list of the others."""
    if not buckets:
        return "false"
    spans = [p.split("-") for p in _ranges(buckets).split(",")]
    wide = [(int(x[0]), int(x[1])) for x in spans if len(x) == 2 and int(x[1]) - int(x[0]) > 1]
    held = {n for a, b in wide for n in range(a, b + 1)}
    rest = [n for n in sorted(buckets) if n not in held]
    tests = [f"{BUCKET} BETWEEN {a} AND {b}" for a, b in wide]
    tests += [f"{BUCKET} IN ({', '.join(map(str, rest))})"] if rest else []
    return "(" + " OR ".join(tests) + ")"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
