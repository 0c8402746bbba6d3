"""Approximate nearest neighbours over learned partitions.

A bounded sample of the vectors (``SAMPLE`` rows picked by a hash of the id, and at most ``SAMPLE_BYTES``) gives a
neighbour graph. The graph is cut into ``parts`` parts of equal size with few edges between them, and a softmax
classifier learns where the neighbours of a vector lie. Every row of the table goes to its most probable part; a query
asks its most probable parts, as many as find the ``target`` share of neighbours among sample vectors that the
classifier wasn't fitted on. Whatever is in an asked part is compared exactly, in double precision.

Parts are stored in blocks of about ``BLOCK_ROWS`` rows dealt by a hash, so that neither a part that many equal vectors
fall into nor a growing table makes a larger task; each block gives its best rows, and a query's best are taken of these.

Null, zero or non-finite vectors, those of another length than most of the sample, and rows without an id take no part;
of rows that repeat an id the smallest vector counts. Fewer candidates than asked for are all returned. Equal
similarities go to the smaller id. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from rowtide.llm.blocks import written

PARTS = 32
SAMPLE = 6000
SAMPLE_BYTES = 64 << 20
NEAR = 10
TARGET = 0.95
BLOCK_ROWS = 2048
QUERY_ROWS = 256
SLACK = 1e-9


@dataclass
class Router:
    """Softmax over parts, and how many parts a query asks."""

    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def order(self, unit: np.ndarray) -> np.ndarray:
        """Parts of each vector, the most probable first (ties to the smaller part)."""
        return np.argsort(-(unit @ self.weights + self.bias), axis=1, kind="stable")


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def neighbour_graph(unit: np.ndarray, near: int) -> np.ndarray:
    """The ``near`` nearest others of each vector, by blocks of rows."""
    out = []
    for a in range(0, len(unit), 512):
        s = unit[a : a + 512] @ unit.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -2
        top = np.argpartition(-s, near - 1, axis=1)[:, :near]
        out.append(np.take_along_axis(top, np.argsort(-np.take_along_axis(s, top, 1), axis=1, kind="stable"), 1))
    return np.concatenate(out)


def _seeds(graph: np.ndarray, back: list[list[int]], parts: int, first: int) -> list[int]:
    """Nodes far from each other: each next one has the most edges to the nearest so far."""
    far, seeds = np.full(len(graph), len(graph) + 1), [first]
    while True:
        far[seeds[-1]], front, hops = 0, [seeds[-1]], 0
        while front:
            hops += 1
            ahead = {int(b) for a in front for b in (*graph[a], *back[a])}
            front = [b for b in ahead if far[b] > hops]
            far[front] = hops
        if len(seeds) == parts:
            return seeds
        seeds.append(int(far.argmax()))


def balanced_cut(graph: np.ndarray, parts: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Part of each node: parts grow along edges from spread seeds, then nodes move to where most neighbours are.

    No part holds more than 5 % above its share.
    """
    n, rng = len(graph), np.random.default_rng(seed)
    limit = int(np.ceil(n / parts * 1.05))
    part, size = np.full(n, -1), np.zeros(parts, int)
    back: list[list[int]] = [[] for _ in range(n)]
    for a, row in enumerate(graph):
        for b in row:
            back[b].append(a)
    order = rng.permutation(n)
    fronts, at = [[s] for s in _seeds(graph, back, parts, int(order[0]))], 0
    while (part < 0).any():
        for p in np.argsort(size, kind="stable"):
            if size[p] >= limit:
                continue
            node = next((x for x in iter(lambda f=fronts[p]: f.pop(0) if f else None, None) if part[x] < 0), None)
            while node is None and at < n:
                node, at = (int(order[at]) if part[order[at]] < 0 else None), at + 1
            if node is None:
                break
            part[node], size[p] = p, size[p] + 1
            fronts[p] += [*graph[node].tolist(), *back[node]]
    for _ in range(rounds):
        for node in rng.permutation(n):
            votes = np.bincount(part[np.concatenate([graph[node], back[node]]).astype(int)], minlength=parts)
            best = int(np.where(size < limit, votes, -1).argmax())
            if votes[best] > votes[part[node]]:
                size[part[node]] -= 1
                size[best] += 1
                part[node] = best
    return part


def classifier(unit: np.ndarray, wanted: np.ndarray, epochs: int = 60, rate: float = 0.05, seed: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """Softmax regression onto the share of each row's neighbours in each part, by Adam over small batches."""
    rng = np.random.default_rng(seed)
    x = np.hstack([unit, np.ones((len(unit), 1))])
    w, m, v, step = np.zeros((x.shape[1], wanted.shape[1])), 0.0, 0.0, 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 256):
            rows = order[a : a + 256]
            z = x[rows] @ w
            p = np.exp(z - z.max(1, keepdims=True))
            g = x[rows].T @ (p / p.sum(1, keepdims=True) - wanted[rows]) / len(rows)
            step += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], w[-1]


def fit(vectors: np.ndarray, parts: int, near: int, target: float, neighbours: int) -> Router:
    """A router from sample vectors; the last fifth of them only sets the number of parts to ask."""
    unit = _unit(vectors)
    parts = max(1, min(parts, len(unit) // (4 * near)))
    dim = vectors.shape[1] if len(vectors) else 0
    if parts == 1:
        return Router(np.zeros((dim, 1)), np.zeros(1), 1)
    own, rest = unit[: len(unit) * 4 // 5], unit[len(unit) * 4 // 5 :]
    graph = neighbour_graph(own, near)
    part = balanced_cut(graph, parts)
    wanted = np.zeros((len(own), parts))
    np.add.at(wanted, (np.arange(len(own))[:, None], part[np.hstack([graph, np.arange(len(own))[:, None]])]), 1 / (near + 1))
    router = Router(*classifier(own, wanted), parts)
    held = router.order(own)[:, 0]  # the index goes by the classifier, not by the cut
    top = np.argpartition(-(rest @ own.T), neighbours - 1, axis=1)[:, :neighbours]
    rank = np.argsort(router.order(rest), axis=1)
    needed = np.sort(np.take_along_axis(rank, held[top], 1).ravel())
    router.probes = int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))))]) + 1
    return router


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part, before their lengths are compared."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0)
    return rows.where(good).groupBy("vec_id").agg(F.min("v").alias("v"))


def _sample(rows: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Vectors of the sample, and the length that most of them have."""
    head = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    if not head[0]:
        return np.zeros((0, 0)), 0
    size = max(1, min(size, SAMPLE_BYTES // (8 * head[1])))
    share = min(1.0, size / head[0])
    even = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    got = rows.where(even < share).orderBy(F.xxhash64("vec_id", F.lit(4))).limit(2 * size).toArrow().column("v").combine_chunks().to_pylist()
    if not got:
        got = [r["v"] for r in rows.orderBy("vec_id").limit(size).toLocalIterator()]
    dim = min(Counter(map(len, got)).items(), key=lambda x: (-x[1], x[0]))[0]
    return np.array([x for x in got if len(x) == dim]).reshape(-1, dim), dim


def _best(queries: tuple[np.ndarray, np.ndarray], rows: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` nearest rows of each query in one block; equal vectors get equal similarities to the last bit."""
    (q_id, q), (r_id, r) = queries, rows
    order = np.argsort(r_id, kind="stable")
    r_id, r = r_id[order], r[order]
    rough = _unit(q) @ _unit(r).T
    rough[q_id[:, None] == r_id[None, :]] = -3
    k = min(k, len(r_id))
    least = np.maximum(np.partition(rough, -k, axis=1)[:, -k] - SLACK, -2)
    a, b = np.nonzero(rough >= least[:, None])
    exact = np.concatenate([np.einsum("ij,ij->i", q[x], r[y]) / (np.sqrt(np.einsum("ij,ij->i", q[x], q[x])) * np.sqrt(np.einsum("ij,ij->i", r[y], r[y]))) for x, y in ((a[s : s + 20_000], b[s : s + 20_000]) for s in range(0, max(len(a), 1), 20_000))])
    order = np.lexsort((r_id[b], -exact, a))
    a, b, exact = a[order], b[order], exact[order]
    keep = np.arange(len(a)) - np.searchsorted(a, a) < k
    return q_id[a[keep]], r_id[b[keep]], exact[keep]


def nearest(table: DataFrame, queries: DataFrame, neighbours: int = 5, parts: int = PARTS, near: int = NEAR, target: float = TARGET, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows of ``table`` found for each row of ``queries`` (same columns)."""
    rows = written(usable(table, id_col, vector_col), "vectors")
    vectors, dim = _sample(rows, sample)
    router = fit(vectors, parts, near, target, neighbours)
    shared = table.sparkSession.sparkContext.broadcast(router)

    def route(probes):
        def run(batches):
            for batch in batches:
                if batch.num_rows:
                    v = np.asarray(batch.column(1).flatten()).reshape(-1, dim)
                    order = shared.value.order(_unit(v))[:, :probes]
                    each = pa.array(np.repeat(np.arange(len(v)), order.shape[1]))
                    yield pa.RecordBatch.from_arrays([pa.array(order.ravel().astype(np.int32)), batch.column(0).take(each), batch.column(1).take(each)], names=["part", "vec_id", "v"])

        return run

    schema = "part int, vec_id long, v array<double>"
    fitting = F.size("v") == dim
    index = written(rows.where(fitting).mapInArrow(route(1), schema), "index")
    sizes = index.groupBy("part").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("n_blocks"))
    asked = usable(queries, id_col, vector_col).where(fitting).mapInArrow(route(router.probes), schema)

    def packed(frame: DataFrame, name: str, block) -> DataFrame:
        """One row for each block, its rows as lists."""
        return frame.withColumn("block", block).groupBy("part", "block").agg(F.collect_list(F.struct("vec_id", "v")).alias(name))

    sizes = written(sizes, "part-sizes")
    rows_of = packed(index.join(sizes, "part"), "rows", F.pmod(F.xxhash64("vec_id"), F.col("n_blocks")).cast("int"))
    asked = written(asked, "asked")
    n_queries = asked.groupBy("part").agg(F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("n_query"))
    queries_of = packed(asked.join(n_queries, "part"), "queries", F.pmod(F.xxhash64("vec_id"), F.col("n_query")).cast("int"))
    # Each block of queries goes to every block of its part.
    queries_of = queries_of.drop("block").join(sizes, "part").select("part", "queries", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block"))

    def compare(batches):
        def side(list_value):
            ids = np.asarray(list_value.field("vec_id"), np.int64)
            return ids, np.asarray(list_value.field("v").flatten()).reshape(len(ids), dim)

        for batch in batches:
            for i in range(batch.num_rows):
                found = _best(*(side(batch.column(c)[i].values) for c in (0, 1)), neighbours)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])

    pairs = queries_of.join(rows_of, ["part", "block"]).select("queries", "rows")
    found = pairs.mapInArrow(compare, "query_id long, vec_id long, score double")
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast(T.IntegerType()))
    return ranked.where(F.col("rank") <= neighbours).select("query_id", "rank", "vec_id", "score")
