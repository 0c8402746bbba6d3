"""Quality selection by importance resampling over hashed n-grams.

Two generative models give the probability of each hashed word uni- and bigram (add-one smoothed): one counted over target
texts, one over all raw texts. A text's log weight is the sum over its n-grams of the log ratio. Adding Gumbel noise, keyed
by (seed, id), and taking the ``k`` largest draws ``k`` texts without replacement with probabilities in proportion to
their weights. The k-th largest is found by counting in ever finer bins, so nothing is sorted into one task.

The models grow with the input: the number of buckets is the power of two at or above ``PER_ROOT_BYTE`` times the square
root of the bytes of all texts, as a text's vocabulary grows, without an upper limit (2^16 at 0.1 GB, 2^20 at 30 GB, 2^26
at 100 TB, where the ratios, four bytes each, are the one thing that tasks hold besides their block).

The target is a bounded sample: at most ``TARGETS`` ids, the smallest by hash. Raw counts cover all texts.

Null and empty texts have no n-gram and weight 0 (log). A row without an id draws its noise by its text. Rows that tie with
the k-th are all selected, as happens only to repeated rows. Without targets both models are flat in the target's place and
the draw follows the raw model alone. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.blocks import ALNUM, blocks, mix, text_of, word_hashes, written

PER_ROOT_BYTE = 4
TARGETS = 20_000
SHARE = 0.25
SEED = 23
BINS = 4096


def _features(column: pa.Array, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram, and the row that it belongs to."""
    hashes, before = word_hashes(*text_of(column), ALNUM)
    row = np.repeat(np.arange(len(before) - 1), np.diff(before))
    two = np.flatnonzero(row[1:] == row[:-1])
    pairs = mix(hashes[two] * np.uint64(3) + mix(hashes[two + 1]))
    return (np.concatenate([hashes, pairs]) % np.uint64(buckets)).astype(np.int64), np.concatenate([row, row[two]])


def buckets_for(docs: DataFrame) -> int:
    """A power of two that grows with the square root of the bytes of ``text``."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return 1 << max(10, math.ceil(PER_ROOT_BYTE * math.sqrt(size)) - 1).bit_length()


def fit(docs: DataFrame, targets: np.ndarray, buckets: int) -> np.ndarray:
    """Log ratio of each bucket, from ``doc_id, text`` rows and the sorted ids of target texts."""

    def count(batches):
        total = np.zeros((2, buckets), np.int64)
        for batch in batches:
            for part in blocks(batch):
                bucket, row = _features(part.column(1), buckets)
                ids = np.asarray(part.column(0).fill_null(-1), np.int64)
                wanted = np.isin(ids, targets) & np.asarray(part.column(0).is_valid())
                np.add.at(total[0], bucket, 1)
                np.add.at(total[1], bucket[wanted[row]], 1)
        at = np.flatnonzero(total[0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[0][at]), pa.array(total[1][at])], names=["bucket", "raw", "target"])

    counted = docs.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.ones(buckets), np.ones(buckets)
    at = np.asarray(counted.column("bucket"))
    raw[at] += np.asarray(counted.column("raw"))
    target[at] += np.asarray(counted.column("target"))
    return (np.log(target / target.sum()) - np.log(raw / raw.sum())).astype(np.float32)


def weigh(docs: DataFrame, ratio: np.ndarray, seed: int = SEED) -> DataFrame:
    """``doc_id, log_weight, draw`` of ``doc_id, text`` rows; the draw is the weight plus Gumbel noise."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def score(batches):
        for batch in batches:
            for part in blocks(batch):
                bucket, row = _features(part.column(1), len(shared.value))
                weight = np.bincount(row, shared.value[bucket], minlength=part.num_rows).astype(np.float64)
                key = mix(np.asarray(part.column(2), np.int64).view(np.uint64) + mix(np.array([seed], np.uint64)))
                even = ((key >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(weight), pa.array(weight - np.log(-np.log(even)))], names=["doc_id", "log_weight", "draw"])

    keyed = docs.select("doc_id", "text", F.coalesce("doc_id", F.xxhash64("text")).alias("key"))
    return keyed.mapInArrow(score, "doc_id long, log_weight double, draw double")


def kth_largest(rows: DataFrame, column: str, k: int, bins: int = BINS) -> float | None:
    """The k-th largest value of a finite column, by counts in bins that narrow until they hold one value."""
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if not n or k <= 0:
        return None
    above, k = 0, min(k, n)
    while low < high:
        width = (high - low) / bins
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(bins - 1)) if width else F.lit(0)
        inside = rows.where((F.col(column) >= low) & (F.col(column) <= high))
        counts = inside.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for r in sorted(counts.collect(), key=lambda r: -r["bin"]):
            if above + r["n"] >= k:
                low, high = r["low"], r["high"]
                break
            above += r["n"]
    return low


def resample(docs: DataFrame, targets: DataFrame, share: float = SHARE, seed: int = SEED, buckets: int | None = None, limit: int = TARGETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, log_weight, draw, selected``; ``targets`` has the ids of good texts. ``buckets`` follow the input unless given."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids = targets.select(F.col(id_col).cast("long").alias("id")).where("id is not null").distinct().orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(limit).toArrow().column("id")
    ratio = fit(docs, np.sort(np.asarray(ids, np.int64)), buckets or buckets_for(docs))
    scored = written(weigh(docs, ratio, seed), "weights")
    least = kth_largest(scored, "draw", round(share * scored.count()))
    return scored.withColumn("selected", F.lit(False) if least is None else F.col("draw") >= least)
