import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from rowtide.llm.quality import buckets_for, fit, kth_largest, resample, weigh
from tests.llm.data import docs_of, odd_texts, rows, table, words

SF = "/root/testdata/sf0.01"


def ids(spark, numbers):
    return spark.createDataFrame([(i,) for i in numbers], "doc_id long")


def test_target_like_texts_weigh_more(spark):
    texts = [(i, " ".join(words(60, i, 50))) for i in range(0, 200, 2)] + [(i, " ".join(w + "x" for w in words(60, i, 50))) for i in range(1, 200, 2)]
    got = resample(docs_of(spark, texts), ids(spark, range(0, 60, 2)), share=0.3).collect()
    even, odd = ([r.log_weight for r in got if r.doc_id % 2 == k] for k in (0, 1))
    assert min(even) > max(odd)
    assert sum(r.selected for r in got) == 60 and all(r.doc_id % 2 == 0 for r in got if r.selected)


def test_weights_by_definition(spark):
    docs = docs_of(spark, [(1, "a b"), (2, "a c"), (3, "d")]).select("doc_id", "text")
    ratio = fit(docs, np.array([1]), buckets=1 << 20)
    n = 1 << 20
    raw, target = {"a": 3, "b": 2, "c": 2, "d": 2, "ab": 2, "ac": 2}, {"a": 2, "b": 2, "ab": 2}
    of = lambda f: np.log(target.get(f, 1) / (n + 3)) - np.log(raw[f] / (n + 7))
    got = {r.doc_id: r.log_weight for r in weigh(docs, ratio).collect()}
    assert np.allclose([got[1], got[2], got[3]], [of("a") + of("b") + of("ab"), of("a") + of("c") + of("ac"), of("d")])


def test_noise_is_gumbel_and_keyed(spark):
    docs = docs_of(spark, [(i, "") for i in range(5000)]).select("doc_id", "text")
    ratio = np.zeros(16)
    draw = {s: np.array([r.draw for r in weigh(docs, ratio, s).orderBy("doc_id").collect()]) for s in (1, 2)}
    assert abs(draw[1].mean() - 0.5772) < 0.06 and abs(draw[1].std() - np.pi / 6**0.5) < 0.06
    assert abs(np.corrcoef(draw[1], draw[2])[0, 1]) < 0.05
    assert (draw[1] == np.array([r.draw for r in weigh(docs, ratio, 1).orderBy("doc_id").collect()])).all()


def test_kth_largest_is_exact(spark):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=500) * 1e6, rng.normal(size=500) * 1e-9, [3.0] * 40]).tolist()
    frame = spark.createDataFrame([(v,) for v in values], "x double")
    for k in (1, 2, 300, 777, 1039, 1040, 9999):
        assert kth_largest(frame, "x", k, bins=16) == sorted(values, reverse=True)[min(k, len(values)) - 1]
    assert kth_largest(frame, "x", 0) is None and kth_largest(frame.limit(0), "x", 3) is None


def test_given_documents(spark):
    docs = table(spark, "documents", SF)
    good = table(spark, "labels", SF).where(F.col("quality") == 1)
    got = resample(docs, good).collect()
    drawn = sorted((r.draw for r in got), reverse=True)
    assert len(got) == docs.count() and sum(r.selected for r in got) == round(0.25 * len(got))
    assert all(r.selected == (r.draw >= drawn[round(0.25 * len(got)) - 1]) for r in got)


def test_odd_texts(spark):
    got = resample(docs_of(spark, odd_texts()), ids(spark, [5, 7])).collect()
    assert len(got) == len(odd_texts())
    assert all(r.log_weight == 0 for r in got if r.doc_id in (1, 2, 3))
    assert len({r.selected for r in got if r.doc_id == 8}) == 1
    assert rows(resample(docs_of(spark, []), ids(spark, []))) == []
    assert len(rows(resample(docs_of(spark, odd_texts()), ids(spark, [])))) == len(odd_texts())


def scrambled(x):
    x &= (1 << 64) - 1
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
    x = (x ^ x >> 27) * 0x94D049BB133111EB % (1 << 64)
    return x ^ x >> 31


def test_whole_operator_against_brute_force(spark):
    texts = [(i, " ".join(words(30 + i % 7, i % 90, 40))) for i in range(1, 120)] + [(200, None), (201, "")]
    targets, share, seed, buckets = range(1, 40), 0.3, 5, 1 << 24
    grams = {i: Counter(w := (t or "").split()) + Counter(zip(w, w[1:])) for i, t in texts}
    raw, target = (sum((g for i, g in grams.items() if i in among), Counter()) for among in (grams, targets))
    total = [math.log(buckets + sum(c.values())) for c in (raw, target)]
    weight = {i: sum(n * (math.log(1 + target[x]) - total[1] - math.log(1 + raw[x]) + total[0]) for x, n in g.items()) for i, g in grams.items()}
    draw = {i: w - math.log(-math.log(((scrambled(i + scrambled(seed)) >> 11) + 0.5) / (1 << 53))) for i, w in weight.items()}
    chosen = set(sorted(draw, key=draw.get)[-round(share * len(texts)) :])
    got = resample(docs_of(spark, texts), ids(spark, targets), share, seed, buckets).collect()
    assert np.allclose([r.log_weight for r in got], [weight[r.doc_id] for r in got], rtol=1e-5, atol=1e-4)
    assert np.allclose([r.draw for r in got], [draw[r.doc_id] for r in got], rtol=1e-5, atol=1e-4)
    assert {r.doc_id for r in got if r.selected} == chosen and len(got) == len(texts)


def test_buckets_grow_with_the_texts(spark):
    number = [buckets_for(docs_of(spark, [(i, "x" * size) for i in range(4)])) for size in (1, 1 << 18, 1 << 20, 1 << 22)]
    assert number[0] == 16 and number[1] == 1 << 12 and number[2] == 1 << 13 and number[3] == 1 << 14
    assert buckets_for(docs_of(spark, [])) == 16


def test_rows_without_an_id_draw_by_their_text(spark):
    got = resample(docs_of(spark, [(None, "a b"), (None, "c d"), (None, "a b")]), ids(spark, []), 0.5).collect()
    assert len({r.draw for r in got}) == 2
