import random
import re

import numpy as np
import pyarrow as pa

from rowtide.llm.components import components
from rowtide.llm.near_dedup import BANDS, ROWS, WORDS, _orders, band_keys, estimate, near_duplicates, registers, signatures
from tests.llm.data import Task, docs_of, odd_texts, peak_mb, rows, same_rows, table, words

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOW)) if x]
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(texts):
    """All pairs, and the least id that links reach."""
    sets = {i: shingles(t) for i, t in texts}
    label = {i: i for i in sets}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                label[max(root(a), root(b))] = min(root(a), root(b))
    return [(i, len(sets[i]), root(i), root(i) == i) for i in ids]


def edited(base, k, rng):
    w = list(base)
    for _ in range(k):
        w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def test_given_documents(spark):
    docs = table(spark, "documents", "/root/testdata/sf0.01")
    assert same_rows(rows(near_duplicates(docs)), brute(rows(docs.select("doc_id", "text"))))


def test_a_large_group_of_near_copies_around_the_threshold(spark):
    rng = random.Random(4)
    base, passage = words(150, 1, 10**6), words(40, 2, 10**6)
    texts = [(1000 - i, edited(base, rng.randrange(9), rng)) for i in range(250)]
    texts += [(2000 + i, " ".join(words(rng.randrange(4, 60), 100 + i, 10**6) + passage)) for i in range(100)]
    texts += [(3000 + i, " ".join(words(6, i // 3, 10**6) + ["end"] * (i % 3 == 2))) for i in range(60)]
    assert same_rows(rows(near_duplicates(docs_of(spark, texts))), brute(texts))


def test_chains_and_short_texts(spark):
    w = [f"c{i}" for i in range(400)]
    texts = [(50 - i, " ".join(w[4 * i : 4 * i + 120])) for i in range(40)]
    texts += [(100, "a b c"), (101, "A  b\tc"), (102, "a b"), (103, "a b c d e f g h i j k"), (104, "a b c d e f g h i j")]
    got = rows(near_duplicates(docs_of(spark, texts)))
    assert same_rows(got, brute(texts))
    assert {r[2] for r in got if r[0] <= 50} == {11}


def test_odd_texts(spark):
    got = near_duplicates(docs_of(spark, odd_texts()))
    want = brute([(i, t) for i, t in odd_texts() if i is not None])
    assert same_rows(sorted(set(rows(got.where("doc_id is not null")))), want)
    assert [tuple(r) for r in got.where("doc_id = 8").collect()] == [(8, 56, 7, False)] * 2
    assert all(r.component_id is None and r.kept for r in got.where("doc_id is null").collect())


def test_a_null_id_never_speaks_for_a_set(spark):
    got = rows(near_duplicates(docs_of(spark, [(None, "a b c d e f"), (3, "a b c d e f"), (None, "z y x w v u")])))
    assert same_rows(got, [(None, 2, 3, False), (3, 2, 3, True), (None, 2, None, True)])


def test_empty(spark):
    assert rows(near_duplicates(docs_of(spark, []))) == []


def test_estimates_are_near_the_true_similarity():
    rng = np.random.default_rng(3)
    m = ROWS * BANDS
    for share in (0.0, 0.5, 0.85, 0.95):
        n, errors = 600, []
        for _ in range(20):
            pool = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
            both = int(2 * n * share / (1 + share))
            a, b = pool[:n], np.concatenate([pool[:both], pool[n : 2 * n - both]])
            sets, before = np.concatenate([a, b]), np.array([0, n, 2 * n])
            r = registers(sets, before, m)
            true = both / (2 * n - both)
            errors.append(estimate(r[:1], r[1:], np.array([n]), np.array([n]))[0] - true)
        assert abs(np.mean(errors)) < 0.03 and np.max(np.abs(errors)) < 0.13


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(200, 200 + i) for i in range(1, 80)] + [(rng.randrange(300, 340), rng.randrange(300, 340)) for _ in range(25)] + [(7, 7)]
    label = {x: x for e in links for x in e}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    linked = {x for a, b in links if a != b for x in (a, b)}
    got = rows(components(spark.createDataFrame(links, "a long, b long"), salts=3))
    assert same_rows(got, [(x, c) for x, c in label.items() if x in linked])
    assert rows(components(spark.createDataFrame([], "a long, b long"))) == []


def test_short_texts_take_little_memory():
    m = ROWS * BANDS
    regs = np.zeros((2000, m), np.uint16)
    regs[np.arange(2000), np.arange(2000) % m] = 7
    orders, keys = _orders(m), []
    assert peak_mb(lambda: keys.append(band_keys(regs, ROWS, orders))) < 40
    assert (np.concatenate([band_keys(regs[a : a + 1], ROWS, orders) for a in range(0, 2000, 50)]) == keys[0][::50]).all()
    batch = pa.RecordBatch.from_arrays([pa.array(range(10_000)), pa.array([f"a b c d e f{i}" for i in range(10_000)])], names=["doc_id", "text"])
    run, out = signatures(Task(), WORDS, m), []
    assert peak_mb(lambda: out.extend(part.num_rows for part in run([batch]))) < 40
    assert sum(out) == 10_000
