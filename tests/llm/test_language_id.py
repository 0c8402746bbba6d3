import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rowtide.llm.language_id import BLOCK, HashTable, Trees, code_lengths, fit, fit_bounded, frequent, held_out, identify, keep_known, run_counts
from tests.llm.data import docs_of, odd_texts, peak_mb, rows, same_rows, table, words

SF = "/root/testdata/sf0.01"


def brute_bits(learnt, text, order):
    """Code length of a text by the definition: counts of every context, escapes down to 8 bits."""
    count = defaultdict(Counter)
    for t in learnt:
        b = bytes(order) + t.lower().encode()
        for i in range(order, len(b)):
            for k in range(order + 1):
                count[b[i - k : i]][b[i]] += 1
    bits, b = 0.0, bytes(order) + text.lower().encode()
    for i in range(order, len(b)):
        for k in range(order, -1, -1):
            seen = count.get(b[i - k : i])
            if seen is None:
                continue
            total, distinct = seen.total(), len(seen)
            if b[i] in seen:
                bits -= math.log2(seen[b[i]] / (total + distinct))
                break
            bits -= math.log2(distinct / (total + distinct))
        else:
            bits += 8
    return bits


def test_code_lengths_are_exact(spark):
    text = ["the cat sat on the mat", "a thé cat", "the the"]
    docs = docs_of(spark, [(i, text[i % 3]) for i in range(40)])
    trees = fit(docs, order=3)
    learnt = [r.text for r in docs.where(~held_out(docs["doc_id"])).collect()]
    asked = ["the cat", "zebra", "THÉ MAT at the", "日本", "q"]
    got = {r.doc_id: r for r in identify(docs_of(spark, list(enumerate(asked))), trees).collect()}
    for i, t in enumerate(asked):
        assert abs(got[i].bits_per_byte * len(t.lower().encode()) - brute_bits(learnt, t, 3)) < 1e-3 * (1 + len(t))


def test_held_out_accuracy(spark):
    docs = table(spark, "documents", SF)
    got = identify(docs, fit(docs)).join(docs.select("doc_id", "lang", held_out(docs["doc_id"]).alias("out")), "doc_id").where("out").collect()
    assert len(got) > 200 and np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_is_by_crc(spark):
    got = spark.range(300).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in got)


def test_labels_of_held_out_rows_are_not_learnt(spark):
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    rest = [i for i in range(200) if i not in out]
    docs = docs_of(spark, [(i, "secret words") for i in out], "xx").union(docs_of(spark, [(i, "open text") for i in rest], "yy")).union(docs_of(spark, [(i, "no label") for i in rest], None))
    assert fit(docs).languages == ["yy"]


def test_odd_texts(spark):
    docs = table(spark, "documents", SF)
    trees = fit(docs)
    got = rows(identify(docs_of(spark, odd_texts()), trees).select("doc_id", "lang_pred", "score"))
    assert len(got) == len(odd_texts())
    none = [(i, t) for i, t in odd_texts() if not any(c.isalpha() for c in t or "")]
    assert same_rows([r for r in got if r[1] == "und"], [(i, "und", 0.0) for i, _ in none])


def test_kept_rows_and_columns(spark):
    docs = table(spark, "documents", SF)
    trees = fit(docs)
    assert keep_known(docs, trees).count() == docs.count()
    odd = docs_of(spark, odd_texts())
    kept = keep_known(odd, trees)
    assert kept.columns == odd.columns
    assert not {1, 2, 3, 10} & {r.doc_id for r in kept.collect()}
    strange = docs_of(spark, [(1, "日本語の文書です。" * 9), (2, "a few plain words 12345 67890 here"), (3, "Ω≈ç√∫˜µ≤≥÷" * 9)])
    assert [r.doc_id for r in keep_known(strange, trees).collect()] == [2]
    assert same_rows([r for r in rows(kept) if r[0] == 8], [r for r in rows(odd) if r[0] == 8])


def test_each_language_keeps_its_share_of_runs(spark):
    counts = [("big", r, 1000 - r) for r in range(100)] + [("rare", r, 1) for r in range(100)]
    kept = frequent(spark.createDataFrame(counts, "lang string, run long, n long"), 60).collect()
    assert sorted((r.lang, r.run) for r in kept) == [(x, r) for x in ("big", "rare") for r in range(30)]


def test_bounds_drop_noise_and_unlearnt_languages_and_keep_clean_documents(spark):
    docs = table(spark, "documents", "/root/testdata/sf0.1")
    trees = fit_bounded(docs)
    assert len(trees.bounds) == 4 and (trees.bounds < 8).all()
    assert keep_known(docs, trees).count() == docs.where(F.col("text").rlike(r"\p{L}")).count()
    rng = np.random.default_rng(5)
    noise = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 600)) for _ in range(20)]
    assert keep_known(docs_of(spark, list(enumerate(noise))), trees).count() == 0
    # A key in a short text is no reason to reject it.
    odd = docs_of(spark, [(1, "token: xK9vQ2mZ7rT4wB8nL1pS the and of in"), (2, "x"), (3, "")])
    assert [r.doc_id for r in keep_known(odd, trees).orderBy("doc_id").collect()] == [1]
    without = fit_bounded(docs.where("lang <> 'fr'"))
    assert without.languages == ["de", "en", "es"]
    long = docs.where((F.col("lang") == "fr") & (F.octet_length("text") > 1000))
    assert keep_known(long, without).count() < 0.02 * long.count()
    rest = docs.where("lang <> 'fr'")
    assert keep_known(rest, without).count() == rest.where(F.col("text").rlike(r"\p{L}")).count()


def test_too_few_texts_have_no_bound(spark):
    docs = docs_of(spark, [(i, f"the text number {i}") for i in range(40)])
    trees = fit_bounded(docs)
    assert (trees.bounds == 16).all() and keep_known(docs, trees).count() == 40


def test_nothing_to_learn(spark):
    odd = docs_of(spark, odd_texts(), None)
    trees = fit(odd)
    assert isinstance(trees, Trees) and trees.languages == [] == fit_bounded(odd).languages
    assert {r.lang_pred for r in identify(odd, trees).collect()} == {"und"}
    assert {4, 5, 6, 11} <= {r.doc_id for r in keep_known(odd, trees).collect()}
    assert rows(identify(docs_of(spark, []), fit(docs_of(spark, [])))) == []


def test_hash_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 5000, dtype=np.uint64))
    found = HashTable(keys)
    assert (found.find(keys) == np.arange(len(keys))).all()
    assert (found.find(keys + np.uint64(1 << 63)) == -1).all()


def test_every_labelled_text_is_learnt_and_every_held_out_one_measured(spark, monkeypatch):
    """More texts a language than the 3000 that once were picked; the runs of each are counted, over several rounds of a task."""
    from rowtide.llm import language_id as li

    monkeypatch.setattr(li, "HELD", 64)
    docs = spark.range(9000).selectExpr("id as doc_id", "concat('the number ', id) as text", "'en' as lang")
    learnt = docs.where(~held_out(F.col("doc_id")))
    assert learnt.count() > 4000
    counts = li.written(run_counts(li.labelled(docs), 3), "runs")
    assert counts.agg(F.sum("n")).first()[0] == learnt.agg(F.sum(F.octet_length("text"))).first()[0]
    assert counts.count() == counts.select("lang", "run").distinct().count()
    got = {r.run: r.n for r in counts.collect()}
    want = Counter(int.from_bytes(b[i - 3 : i + 1]) for r in learnt.collect() for b in [bytes(3) + r.text.encode()] for i in range(3, len(b)))
    assert got == want
    assert li.labelled(docs, out=True).count() == 9000 - learnt.count()
    assert (fit_bounded(docs).bounds < 8).all()


def test_ties_fall_to_the_smaller_run_of_all(spark):
    rng = np.random.default_rng(3)
    runs = {x: np.unique(rng.integers(0, 1 << 40, 3000)) for x in ("a", "b")}
    counts = [(x, int(r), int(n)) for x, held in runs.items() for r, n in zip(held, rng.integers(1, 4, len(held)))] + [("c", 7, 1)]
    kept = {tuple(r) for r in frequent(spark.createDataFrame(counts, "lang string, run long, n long"), 6000).collect()}
    want = {r for x in ("a", "b", "c") for r in sorted((c for c in counts if c[0] == x), key=lambda c: (-c[2], c[1]))[:2000]}
    assert kept == want


def test_scoring_takes_little_memory():
    rng = np.random.default_rng(5)
    runs = [np.unique(rng.integers(0, 1 << 8 * (k + 1), 1 << 14).astype(np.uint64)) for k in range(3)]
    contexts = [np.unique(x >> np.uint64(8)) for x in runs]
    bits, escapes = ([np.ones((len(x), 4), np.float32) for x in y] for y in (runs, contexts))
    trees = Trees(list("abcd"), 2, runs, bits, contexts, escapes)
    trees.costs(np.zeros(1, np.uint64))
    text, out = pa.array([" ".join(words(300_000, 1))]), []
    assert len(text[0].as_py()) > 4 * BLOCK
    assert peak_mb(lambda: out.append(code_lengths(trees, text))) < 40
    size, bits = out[0]
    assert size[0] == len(text[0].as_py()) and (bits[0] >= size[0]).all()
