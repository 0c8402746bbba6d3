"""Repeated passages across documents, by hashing lines and sentences.

A text's units are its lines, cut again after each sentence end. A unit is normalised (lower case, runs of white space as
one blank); its 128-bit digest, and that of each two neighbouring units, are grouped over all documents. The earliest
ranked occurrence (smallest id, then a key of the text, then the place) is never taken out. A unit is repeated if it has
an earlier occurrence, and two neighbouring repeated units hang together if they have stood so before. What hangs together
goes if its units have ``LEAST`` bytes or more (bytes, so that scripts without blanks count alike): a long line or
sentence on its own, a passage of short ones as a whole, but no short unit that is repeated by chance. The offsets of all
that is taken out, in the original text, are returned (code points, end exclusive).

Only (digest, id, key, place) is shuffled by digest, after each task has kept its own earliest; a digest in a third of all
documents is one row per task by then. What is earliest is then grouped by row, so no repeated line brings its documents
together. Rows equal in id and text are counted: one of them is judged as any other row, all others as repeats of it.

Null and empty texts have no units; null ids rank last. Rows that share an id or have none are told apart by their text,
and of equal rows one keeps its text. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.blocks import blocks, mix, written

LEAST = 150
COPIES = 10_000  # equal rows are written out in pieces of so many
UNIT = re.compile(r"\S(?:[^\n.!?]|[.!?](?!\s))*(?:[.!?]+(?=\s|$))?")


def units(text: str) -> list[tuple[int, int, bytes]]:
    """Start, end and digest of each unit."""
    out = []
    for m in UNIT.finditer(text):
        whole = m[0].rstrip()
        out.append((m.start(), m.start() + len(whole), hashlib.blake2b(" ".join(whole.lower().split()).encode(), digest_size=16).digest()))
    return out


def _digests(found: list[list[tuple[int, int, bytes]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(two 64-bit halves, row, place) of all units and pairs of texts; unit k stands at 2k, its pair with the next at 2k + 1."""
    held = np.frombuffer(b"".join(d for u in found for _, _, d in u), np.uint64).reshape(-1, 2)
    size = np.array([len(u) for u in found], np.int64)
    row = np.repeat(np.arange(len(found)), size)
    place = np.arange(len(held)) - np.repeat(np.cumsum(size) - size, size)
    two = np.flatnonzero(row[1:] == row[:-1]) if len(row) else np.zeros(0, np.int64)
    pairs = mix(held[two] + mix(held[two + 1] + np.array([3, 7], np.uint64)))
    return np.concatenate([held, pairs]).view(np.int64), np.concatenate([row, row[two]]), np.concatenate([2 * place, 2 * place[two] + 1])


def unit_rows(docs: DataFrame) -> DataFrame:
    """``d1, d2, doc_id, row, place`` of each unit and pair of ``doc_id, row, text`` rows, the first of equal ones in a text only."""

    def cut(batches):
        for batch in batches:
            for part in blocks(batch):
                digest, row, place = _digests([units(t or "") for t in part.column(2).to_pylist()])
                order = np.lexsort((place, digest[:, 1], digest[:, 0], row))
                digest, row, place = digest[order], row[order], place[order]
                first = np.ones(len(row), bool)
                first[1:] = (row[1:] != row[:-1]) | (digest[1:] != digest[:-1]).any(1)
                digest, row, place = digest[first], pa.array(row[first]), place[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest[:, 0].copy()), pa.array(digest[:, 1].copy()), part.column(0).take(row), part.column(1).take(row), pa.array(place.astype(np.int32))],
                    names=["d1", "d2", "doc_id", "row", "place"],
                )

    return docs.mapInArrow(cut, "d1 long, d2 long, doc_id long, row long, place int")


def repeats(found: list[tuple[int, int, bytes]], sizes: list[int], earliest: set[int], least: int) -> list[tuple[int, int]]:
    """Spans of the units that go, ``earliest`` naming the places of units and pairs that are nowhere earlier."""
    gone, run, total = [], [], 0
    for k, (a, b, _) in enumerate(found):
        if 2 * k in earliest:
            continue
        if not (run and run[-1] == k - 1 and 2 * k - 1 not in earliest):
            gone += run if total >= least else []
            run, total = [], 0
        run.append(k)
        total += sizes[k]
    gone += run if total >= least else []
    return [found[k][:2] for k in gone]


def remove_repeats(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_units, removed, text``: the spans taken out, and the text without them."""
    text = F.col(text_col).cast("string")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("row"), text.alias("text"))
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "place")
    first = unit_rows(docs).groupBy("d1", "d2").agg(F.min(rank).alias("first")).select("first.doc_id", "first.row", "first.place")
    kept = written(first.groupBy(F.col("doc_id").alias("own"), F.col("row").alias("own_row")).agg(F.collect_set("place").alias("kept")), "kept-units")
    mine = F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("row") == F.col("own_row"))

    def take_out(batches):
        for batch in batches:
            for part in blocks(batch):
                n_units, removed, texts = [], [], []
                for text, stay in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    found = units(text or "")
                    gone = repeats(found, [len(text[a:b].encode()) for a, b, _ in found], set(stay or ()), least)
                    left, at = [], 0
                    for a, b in gone:
                        left.append(text[at:a])
                        at = b
                    n_units.append(len(found))
                    removed.append([{"start": a, "end": b} for a, b in gone])
                    texts.append(text if text is None else "".join(left) + text[at:])
                spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_units, pa.int64()), pa.array(removed, spans), pa.array(texts, pa.string()), part.column(3)], names=["doc_id", "n_units", "removed", "text", "times"])

    def judged(rows: DataFrame, held: Column) -> DataFrame:
        return rows.select("doc_id", "text", held.alias("kept"), "times").mapInArrow(take_out, "doc_id long, n_units long, removed array<struct<start:int,end:int>>, text string, times long")

    # Equal rows are one row with a count; the second and all further ones are repeats of the first.
    same = ["doc_id", "row"]
    many = written(docs.groupBy(*[F.col(c).alias(f"{c}_of") for c in same]).count().where("count > 1").drop("count"), "equal-rows")
    shared = F.col("doc_id").eqNullSafe(F.col("doc_id_of")) & (F.col("row") == F.col("row_of"))
    alone = docs.join(many, shared, "left_anti").withColumn("times", F.lit(1).cast("long"))
    counted = docs.join(many, shared, "left_semi").groupBy("doc_id", "row", "text").agg(F.count(F.lit(1)).alias("times"))
    out = [judged(rows.join(kept, mine, "left"), F.col("kept")) for rows in (alone, counted)]
    again = judged(counted.where("times > 1"), F.array().cast("array<int>"))
    pieces = again.withColumn("piece", F.explode(F.sequence(F.lit(2).cast("long"), "times", F.lit(COPIES).cast("long")))).repartition(F.col("doc_id"), F.col("piece"))
    copies = pieces.withColumn("copy", F.explode(F.sequence("piece", F.least(F.col("piece") + COPIES - 1, "times"))))
    columns = ["doc_id", "n_units", "removed", "text"]
    return out[0].select(*columns).unionByName(out[1].select(*columns)).unionByName(copies.select(*columns))
