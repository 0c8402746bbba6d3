"""Texts of an Arrow batch as flat bytes, words and word hashes; written tables shared by operators.

Helpers of the Arrow functions: everything here works on the rows of one batch in NumPy. Batches are cut into blocks
of a few megabytes, so that memory follows the block (or the one longest text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from rowtide.session import shared_dir

BLOCK_BYTES = 512 << 10
_BASE = 0x9E3779B97F4A7C15 | 1
_POWERS: list[np.ndarray] = []

SPACES = np.ones(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """Write the rows into the shared folder and read them back: lineage ends, nothing is computed twice."""
    spark = frame.sparkSession
    path = shared_dir(spark, purpose)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and where each row starts; the last offset is the end."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    flat = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    return flat, at - at[0]


def blocks(batch: pa.RecordBatch, column: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about ``limit`` bytes together; a longer text is a run of its own."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    part = np.cumsum(np.asarray(size, np.int64) + 16) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        n = max(n, BLOCK_BYTES + (BLOCK_BYTES >> 2))
        inverse = pow(_BASE, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)])) for b in (_BASE, inverse)]
    return _POWERS[0], _POWERS[1]


def spans(flat: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that ``table`` accepts, none over two rows: starts, ends, and runs before each row."""
    inside = np.zeros(len(flat) + 2, bool)
    inside[1:-1] = table[flat]
    begins = inside[1:-1] & ~inside[:-2]
    stops = inside[1:-1] & ~inside[2:]
    edges = at[:-1][np.diff(at) > 0]
    begins[edges] = inside[edges + 1]
    last = at[1:][np.diff(at) > 0] - 1
    stops[last] = inside[last + 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, at)


def word_hashes(flat: np.ndarray, at: np.ndarray, table: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word (lower-cased with ``fold``), and how many words stand before each row (with the total last)."""
    flat = LOWER[flat] if fold else flat
    starts, ends, before = spans(flat, at, table)
    out = np.empty(len(starts), np.uint64)
    # Runs of words of about a block's bytes, so that a very long text needs no eight bytes a byte at once.
    cuts = [0]
    while cuts[-1] < len(starts):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, starts[cuts[-1]] + BLOCK_BYTES, "right"))))
    for a, b in zip(cuts, cuts[1:]):
        low, high = starts[a], ends[b - 1]
        power, inverse = _powers(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((flat[low:high].astype(np.uint64) + np.uint64(1)) * power[: high - low], out=sums[1:])
        s, e = starts[a:b] - low, ends[a:b] - low
        out[a:b] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
    return out, before


def ragged(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The positions begin[i], begin[i] + 1, ... of every run, one run after the other."""
    total = int(length.sum())
    ends = np.cumsum(length)
    return np.repeat(begin - (ends - length), length) + np.arange(total)
