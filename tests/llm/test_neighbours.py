import math

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.frames import small_frame
from rowtide.llm import neighbours
from rowtide.llm.neighbours import balanced_cut, nearest, neighbour_graph
from tests.llm.data import rows, table

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("part", T.StringType()), T.StructField("v", T.StringType()), T.StructField("rank", T.StringType())])


def vectors_of(spark, pairs):
    return small_frame(spark, [(i, v, "p", "v", "r") for i, v in pairs], SCHEMA)


def brute(pairs, asked, k=5):
    """The true nearest of each asked id, over usable rows."""
    ok = {}
    for i, v in pairs:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            ok[i] = min(v, ok.get(i, v))
    out = {}
    for q in asked:
        if q in ok:
            s = [(-sum(a * b for a, b in zip(ok[q], v)) / (math.hypot(*ok[q]) * math.hypot(*v)), i) for i, v in ok.items() if i != q]
            out[q] = [(i, -x) for x, i in sorted((round(x, 12), i) for x, i in s)[:k]]
    return out


def test_recall_on_given_vectors(spark):
    own = table(spark, "embeddings", "/root/testdata/sf0.1")
    got = {}
    for r in nearest(own, own.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    pairs = [(r.vec_id, list(r.embedding)) for r in own.collect()]
    want = brute(pairs, [i for i, _ in pairs if i % 50 == 0])
    assert got.keys() == want.keys() and all(len(x) == 5 for x in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in pairs}
    assert all(abs(s - unit[q] @ unit[i]) < 1e-12 for q, x in got.items() for i, s in x)


def test_odd_vectors_ties_and_few_candidates(spark):
    pairs = [(0, [1.0, 0.0]), (50, [0.0, 2.0]), (1, [3.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 0.0]), (2, [2.0, 0.0]), (100, None), (8, [])]
    got = nearest(vectors_of(spark, pairs), vectors_of(spark, pairs).where("vec_id % 50 = 0")).orderBy("query_id", "rank")
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 50, 0.0), (50, 1, 0, 0.0), (50, 2, 1, 0.0), (50, 3, 2, 0.0)]


def test_a_common_vector_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 3)
    rng = np.random.default_rng(1)
    same = rng.normal(size=8).tolist()
    pairs = [(i, same if i % 3 == 0 else rng.normal(size=8).tolist()) for i in range(900)]
    frame = vectors_of(spark, pairs)
    got = {}
    for r in nearest(frame, frame.where(F.col("vec_id") % 50 == 0), target=1.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    want = brute(pairs, range(0, 900, 50))
    assert all(got[q] == [i for i, _ in want[q]] for q in want if q % 3 == 0)
    assert sum(len(set(got[q]) & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)


def test_empty(spark):
    none = vectors_of(spark, [])
    some = vectors_of(spark, [(0, [1.0, 2.0])])
    assert rows(nearest(none, none)) == [] == rows(nearest(some, some)) == rows(nearest(some, none))


def test_cut_is_balanced_and_follows_clusters():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 16))
    x = np.repeat(centres, 100, 0) + 0.1 * rng.normal(size=(400, 16))
    graph = neighbour_graph(x / np.linalg.norm(x, axis=1)[:, None], 8)
    part = balanced_cut(graph, 4)
    assert np.bincount(part).max() <= 105
    assert np.mean(part[graph] == part[:, None]) > 0.9
