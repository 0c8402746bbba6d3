"""Near-duplicate documents by HyperMinHash registers, banding, and confirmation on the full shingle sets.

1. A document's set is its distinct runs of ``WORDS`` words (all words, where there are fewer). Equal sets are one node.
2. Each shingle falls into one of ``ROWS * BANDS`` buckets; a bucket's register keeps the leading zeros and ten mantissa
   bits of its smallest hash. For banding, an empty bucket borrows from the first full one in an order of its own.
3. Nodes that agree on all registers of a band share a bin. Two leaders of each bin are compared with its other members:
   first by the Jaccard estimate of the registers, less the expected number of chance collisions, then on the sets.
   Links join nodes into components.
4. Bins of more than three nodes that still hold several components are finished exactly: their nodes go through a
   prefix join (sets ordered from the rarest shingle; similar sets share one of the first ones). Of each shingle's nodes
   those outside its largest component are compared with the others. So no bin is enumerated pair by pair, however
   large, and none is cut off.

Null and empty texts have no shingles and link to nothing. Rows with a null id never speak for a set. Repeated rows
are equal sets. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.blocks import SPACES, blocks, fresh, mix, text_of, word_hashes, written
from rowtide.llm.components import components

WORDS = 5
PERCENT = 85
ROWS = 6
BANDS = 28
MANTISSA = 10
SLACK = 0.13  # five standard deviations of the estimate at the threshold
SKETCH = 1 << 18
#: Rows of registers, and empty registers, that are worked on at once: short texts have many of both to a block.
SOME = 1000
#: Expected share of equal registers among two unrelated equal-sized sets, times 2 ** mantissa bits.
COLLISIONS = 0.169919487159739

_SALT = np.uint64(0x632BE59BD9B4E019)


def shingle_sets(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sorted 64-bit shingle hashes of each row, one row after the other, and how many stand before each row."""
    hashes, before = word_hashes(*text_of(column), SPACES)
    n = np.diff(before)
    run = np.zeros(len(hashes), np.uint64)
    for k in range(words):  # a run that would leave its row is not used
        run[: len(run) - k] += mix(hashes[k:] + np.uint64(k + 1)) * np.uint64(2 * k + 3)
    sets = []
    for a, size in zip(before[:-1].tolist(), n.tolist()):
        if size >= words:
            sets.append(np.unique(mix(run[a : a + size - words + 1])))
        elif size:
            short = mix(hashes[a : a + size] + np.arange(1, size + 1, dtype=np.uint64)) * np.arange(3, 2 * size + 3, 2, dtype=np.uint64)
            sets.append(mix(short.sum(keepdims=True) + np.uint64(size)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)])


def registers(sets: np.ndarray, before: np.ndarray, m: int) -> np.ndarray:
    """The compressed registers of each set: 0 empty, else 1 + 1024 * leading zeros + mantissa."""
    row = np.repeat(np.arange(len(before) - 1), np.diff(before))
    least = np.full((len(before) - 1) * m, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, row * m + (sets % np.uint64(m)).astype(np.int64), mix(sets ^ _SALT))
    full = np.zeros(len(least), bool)
    full[row * m + (sets % np.uint64(m)).astype(np.int64)] = True
    top = np.maximum(np.frexp(least.astype(np.float64))[1] - 1, 0).astype(np.int64)
    top = np.minimum(top, 63)
    mantissa = (np.where(top >= MANTISSA, least >> np.maximum(top - MANTISSA, 0).astype(np.uint64), least << np.maximum(MANTISSA - top, 0).astype(np.uint64))) & np.uint64((1 << MANTISSA) - 1)
    code = 1 + (np.minimum(63 - top, 62) << MANTISSA) + mantissa.astype(np.int64)
    return np.where(full, code, 0).astype(np.uint16).reshape(-1, m)


def _orders(m: int) -> np.ndarray:
    """For each bucket the order in which it asks the others when it is empty."""
    seed = mix(np.arange(m * m, dtype=np.uint64) + _SALT).reshape(m, m)
    return seed.argsort(1).astype(np.min_scalar_type(m))


def band_keys(regs: np.ndarray, rows: int, orders: np.ndarray) -> np.ndarray:
    """One key for each band of each node (none of whose registers may all be empty)."""
    m = regs.shape[1]
    source = np.tile(np.arange(m), (len(regs), 1))
    node, place = np.nonzero(regs == 0)
    for a in range(0, len(node), SOME):
        n, p = node[a : a + SOME], place[a : a + SOME]
        first = (regs[n][:, :] != 0)[np.arange(len(n))[:, None], orders[p]].argmax(1)
        source[n, p] = orders[p, first]
    value = np.take_along_axis(regs, source, 1).astype(np.uint64) | source.astype(np.uint64) << np.uint64(16)
    value = mix(value + (np.arange(m, dtype=np.uint64) << np.uint64(32)))
    return mix(value.reshape(len(regs), -1, rows).sum(2, dtype=np.uint64))


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard estimate from two rows of registers, corrected for chance collisions."""
    used = ((a != 0) | (b != 0)).sum(1)
    equal = ((a == b) & (a != 0)).sum(1)
    ratio = n_a / np.maximum(n_b, 1)
    chance = COLLISIONS / (1 << MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return np.clip((equal - chance * used) / np.maximum(used * (1 - chance), 1e-9), 0, 1)


def signatures(docs: DataFrame, words: int, m: int) -> DataFrame:
    """``doc_id, n, d1, d2, regs`` of each row; d1 and d2 identify the set."""

    def sign(batches):
        for batch in batches:
            for part in (block.slice(a, SOME) for block in blocks(batch) for a in range(0, block.num_rows, SOME)):
                sets, before = shingle_sets(part.column(1), words)
                regs = registers(sets, before, m)
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets ^ np.uint64(s)))]) for s in (11, 12)]
                d = [pa.array((s[before[1:]] - s[before[:-1]]).view(np.int64)) for s in sums]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(before)), *d, pa.array([r.tobytes() for r in regs], pa.binary())], names=["doc_id", "n", "d1", "d2", "regs"])

    return docs.mapInArrow(sign, "doc_id long, n long, d1 long, d2 long, regs binary")


def _bins(nodes: DataFrame, rows: int, bands: int) -> DataFrame:
    """``bin, node, n`` for each band of each node."""
    m = rows * bands

    def cut(batches):
        orders = _orders(m)
        for batch in batches:
            for a in range(0, batch.num_rows, SOME):
                part = batch.slice(a, SOME)
                regs = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint16).reshape(-1, m)
                keys = mix(band_keys(regs, rows, orders) + np.arange(bands, dtype=np.uint64))
                each = pa.array(np.repeat(np.arange(part.num_rows), bands))
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), part.column(0).take(each), part.column(1).take(each)], names=["bin", "node", "n"])

    return nodes.select("node", "n", "regs").mapInArrow(cut, "bin long, node long, n long")


def _alike(percent: int):
    return 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")


def _ordered(left: str, n_left: str, right: str, n_right: str) -> list:
    """a, b, n_a, n_b of a pair, the smaller node first."""
    turn = F.col(left) < F.col(right)
    return [
        F.least(left, right).alias("a"),
        F.greatest(left, right).alias("b"),
        F.when(turn, F.col(n_left)).otherwise(F.col(n_right)).alias("n_a"),
        F.when(turn, F.col(n_right)).otherwise(F.col(n_left)).alias("n_b"),
    ]


def _estimated(pairs: DataFrame, nodes: DataFrame, m: int, least: float) -> DataFrame:
    """The pairs whose registers allow the similarity asked for."""

    def keep(batches):
        for batch in batches:
            for s in range(0, batch.num_rows, 5000):
                part = batch.slice(s, 5000)
                a, b = (np.frombuffer(b"".join(part.column(k).to_pylist()), np.uint16).reshape(-1, m) for k in (4, 5))
                n_a, n_b = (np.asarray(part.column(k), np.int64) for k in (2, 3))
                yield part.select([0, 1]).filter(pa.array(estimate(a, b, n_a, n_b) >= least))

    sides = [nodes.select(F.col("node").alias(x), F.col("regs").alias(f"regs_{x}")) for x in "ab"]
    beside = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "n_a", "n_b", "regs_a", "regs_b")
    return beside.mapInArrow(keep, "a long, b long")


def _sets_of(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """``node, shingles`` of the asked-for nodes (doc ids)."""

    def make(batches):
        for batch in batches:
            for part in blocks(batch):
                sets, before = shingle_sets(part.column(1), words)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(sets.view(np.int64)))], names=["node", "shingles"])

    asked = docs.join(nodes, F.col("doc_id") == F.col("node"), "left_semi")
    return asked.mapInArrow(make, "node long, shingles array<long>").dropDuplicates(["node"])


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    sides = [sets.select(F.col("node").alias(x), F.col("shingles").alias(f"set_{x}")) for x in "ab"]
    beside = pairs.join(sides[0], "a").join(sides[1], "b").withColumn("both", F.size(F.array_intersect("set_a", "set_b")))
    return beside.where(100 * F.col("both") >= percent * (F.size("set_a") + F.size("set_b") - F.col("both"))).select("a", "b")


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """``shingle, at, node, n``: of each set the shingles, rarest first, of which similar sets share one, with their places.

    How rare a shingle is comes from a count sketch of fixed size (``SKETCH`` counters) over the given sets; any one
    order of all shingles is right, so chance collisions of the sketch cost time only.
    """
    slot = F.pmod(F.col("shingle"), F.lit(SKETCH)).cast("int")
    counted = sets.select(F.explode("shingles").alias("shingle")).groupBy(slot.alias("slot")).agg(F.count("*").alias("n")).toArrow()
    counts = np.zeros(SKETCH, np.int64)
    counts[np.asarray(counted.column("slot"))] = np.asarray(counted.column("n"))
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def head(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                part = batch.slice(a, 500)
                out, size = [], []
                for s in part.column(1):
                    s = np.asarray(s.values, np.int64)
                    keep = len(s) - -(-percent * len(s) // 100) + 1
                    out.append(s[np.lexsort((s, shared.value[s % SKETCH]))[:keep]])
                    size.append(len(s))
                each = pa.array(np.repeat(np.arange(len(out)), [len(x) for x in out]))
                at = np.concatenate([np.arange(len(x)) for x in out])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out)), pa.array(at), part.column(0).take(each), pa.array(np.array(size)).take(each)], names=["shingle", "at", "node", "n"])

    return sets.mapInArrow(head, "shingle long, at long, node long, n long")


def _exact_rest(prefixes: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Pairs over component borders that share a prefix shingle, one of the two outside the shingle's largest component.

    Sets in one order share nothing before their first common shingle, so of a similar pair's sets enough must be left
    from there on; that keeps apart sets whose rare shingles are mostly their own.
    """
    placed = prefixes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    placed = written(placed, "prefixes")
    sizes = placed.groupBy("shingle", "component").agg(F.count("*").alias("c"))
    largest = sizes.groupBy("shingle").agg(F.max(F.struct("c", "component"))["component"].alias("largest"), F.count("*").alias("parts"))
    outside = placed.join(written(largest.where(F.col("parts") > 1), "largest"), "shingle").where(F.col("component") != F.col("largest"))
    outside = outside.select("shingle", F.col("node").alias("x"), F.col("n").alias("n_x"), F.col("at").alias("at_x"), F.col("component").alias("own"))
    left = F.least(F.col("n") - F.col("at"), F.col("n_x") - F.col("at_x"))
    enough = (100 + percent) * left >= percent * (F.col("n") + F.col("n_x"))
    pairs = outside.join(placed, "shingle").where((F.col("own") != F.col("component")) & enough)
    return pairs.select(*_ordered("x", "n_x", "node", "n")).distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id, kept``: the smallest id that links reach, and whether it is the row's own."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    m = rows * bands
    signed = written(signatures(docs, words, m), "signatures")
    nodes = signed.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("node"), F.first("regs").alias("regs"))
    nodes = written(nodes, "nodes")
    bins = written(_bins(nodes, rows, bands), "bins")

    draw = F.struct(F.xxhash64("bin", "node").alias("draw"), "node", "n")
    leaders = bins.groupBy("bin").agg(F.min(draw).alias("one"), F.max(draw).alias("two"), F.count("*").alias("size")).where(F.col("size") > 1)
    leaders = leaders.select("bin", "size", F.array("one", "two").alias("leaders"))
    members = written(bins.join(written(leaders, "leaders"), "bin"), "members")
    stars = members.select("node", "n", F.explode("leaders").alias("lead")).select("node", "n", F.col("lead.node").alias("x"), F.col("lead.n").alias("n_x")).where(F.col("node") != F.col("x"))
    stars = written(stars.select(*_ordered("node", "n", "x", "n_x")).where(_alike(percent)).distinct(), "stars")

    least = percent / 100 - SLACK
    close = written(_estimated(stars, nodes, m, least), "close")
    crowded = members.where(F.col("size") > 3).select("bin", "node")
    wanted = close.select(F.col("a").alias("node")).union(close.select(F.col("b").alias("node"))).union(crowded.select("node")).distinct()
    sets = written(_sets_of(docs, wanted, words), "sets")
    links = written(_confirmed(close, sets, percent), "links")
    found = written(components(links), "components")

    owned = crowded.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = owned.groupBy("bin").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(F.col("low") != F.col("high")).select("bin")
    rest = crowded.join(written(mixed, "mixed"), "bin", "left_semi").select("node").distinct()
    prefixes = _prefixes(sets.join(written(rest, "rest"), "node", "left_semi"), percent)
    more = _estimated(written(_exact_rest(prefixes, found, percent), "rest-pairs"), nodes, m, least)
    more = _confirmed(more, sets, percent)
    found = written(components(links.union(more)), "components")

    placed = written(nodes.join(found, "node", "left").select("n", "d1", "d2", F.coalesce("component", "node").alias("component_id")), "placed")
    own = signed.select("doc_id", "n", "d1", "d2").join(placed, ["n", "d1", "d2"], "left")
    component = F.coalesce("component_id", "doc_id")
    return own.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows without near copies, and of each group those with the smallest id, with all their columns.

    Rows that repeat an id stay or go together. Rows without an id rank behind all others, by a hash of their text, and of
    several with the same text one stays; rows without words are copies of nothing.
    """
    number, text = F.col(id_col).cast("long"), F.col(text_col).cast("string")
    key = F.coalesce(number, F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(text), 2))
    found = near_duplicates(docs.select(key.alias("doc_id"), text.alias("text"))).where("kept")
    own = fresh(docs, "kept_id")
    kept = written(found.select(F.col("doc_id").alias(own)).distinct(), "kept-ids")
    named = number.isNotNull() | ~F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    stay, copies = (docs.where(x).join(kept, key == F.col(own), "left_semi") for x in (named, ~named))
    # Rows without an id that have the same text: the one with the least hash of all columns, and of equal rows one.
    held, least = fresh(docs, "held_text"), fresh(docs, "least_row")
    row = F.xxhash64(*[F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))])
    first = copies.groupBy(text.alias(held)).agg(F.min(row).alias(least))
    chosen = copies.join(first, (text == F.col(held)) & (row == F.col(least)), "left_semi")
    return stay.unionByName(chosen.dropDuplicates([c for c in docs.columns if c in (id_col, text_col)]))
