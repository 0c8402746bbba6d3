import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.frames import small_frame
from rowtide.llm.blocks import ALNUM, text_of, word_hashes, written
from rowtide.llm.decontamination import contamination, near_terms, postings, row_contamination
from tests.llm.data import docs_of, odd_texts, rows, same_rows, table, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOW))


def brute(docs, tests, n=13):
    """Documents (id, text) against items (id, text), by looking at every place."""
    windows = {}
    for item, text in tests:
        w = split(text)
        for i in range(max(1, len(w) - n + 1)) if w else ():
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = split(text)
        hit, items = set(), set()
        for k in lengths:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    items |= windows[tuple(w[i : i + k])]
        listed = ",".join(sorted(map(str, items)))
        out.append((doc, len(w), len(hit), len(items), hashlib.sha256(listed.encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def items_of(spark, items):
    schema = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("doc_id", T.LongType()), T.StructField("window", T.LongType())])
    return small_frame(spark, [(*i, 1, 2) for i in items], schema)


def test_given_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, tests = table(spark, "documents", sf), table(spark, "benchmark", sf)
    want = brute(rows(docs.select("doc_id", "text")), rows(tests.select("item_id", "text")))
    assert any(r[5] for r in want) and same_rows(rows(contamination(docs, tests)), want)


def small():
    a, b = words(40, 1), words(30, 2)
    items = [(1, " ".join(a)), (2, "  ".join(a[5:20]).upper()), (3, " ".join(b)), (4, "Short One"), (5, "!?"), (6, None), (10, "the " * 20), (None, " ".join(words(20, 9)))]
    texts = [
        (1, " ".join(words(50, 3) + a + words(50, 4))),
        (2, ",".join(a[:12] + ["x"] + a[12:])),
        (3, "short-one short one"),
        (4, "the " * 40 + "short"),
        (5, " ".join(b[:13] + b[1:14])),
        (6, " ".join(words(20, 9))),
        (7, " ".join(words(700, 5) + a[:13])),
    ]
    return texts, items


def test_phrases_overlaps_and_short_items(spark):
    texts, items = small()
    for lists in (1, 2, 3):
        got = rows(contamination(docs_of(spark, texts), items_of(spark, items), lists=lists))
        want = brute(texts, items)
        assert same_rows([r for r in got if r[0] != 6], [r for r in want if r[0] != 6]), lists
        assert [r[1:3] for r in got if r[0] == 6] == [(20, 20)]


def test_vocabulary_in_blocks(spark):
    texts, items = small()
    whole = rows(contamination(docs_of(spark, texts), items_of(spark, items)))
    assert same_rows(rows(contamination(docs_of(spark, texts), items_of(spark, items), limit=7)), whole)


def test_odd_texts(spark):
    texts = [(i, t) for i, t in odd_texts() if i not in (None, 8)]
    items = [(1, texts[7][1]), (2, "one"), (3, "日本語 の")]
    got = rows(contamination(docs_of(spark, odd_texts()), items_of(spark, items)))
    assert same_rows([r for r in got if r[0] not in (None, 8)], brute(texts, items))
    assert [r[0] for r in got].count(8) == 1 and [r[0] for r in got].count(None) == 1


def test_empty_tables(spark):
    texts, items = small()
    assert rows(contamination(docs_of(spark, []), items_of(spark, items))) == []
    assert same_rows(rows(contamination(docs_of(spark, texts), items_of(spark, []))), brute(texts, []))


def test_proximity(spark):
    docs = docs_of(spark, [(1, "a x y b z c"), (2, "c q q q q q b a")]).select(F.col("doc_id").alias("id"), "text")
    terms = postings(docs.select(F.lit(0).cast("long").alias("id"), F.lit("").alias("text")), spark.createDataFrame([], "term long"), spark.createDataFrame([], "term long"))
    assert rows(terms.where("term is not null")) == []
    from rowtide.llm.decontamination import item_windows as windows

    every = windows(items_of(spark, [(1, "a"), (2, "b"), (3, "c")]))
    ids = {r.item_id: r.terms[0] for r in every.collect()}
    asked = every.select(F.explode("terms").alias("term"))
    index = written(postings(docs, asked, asked), "index")
    assert rows(near_terms(index, list(ids.values()), 6)) == [(1, 0)]
    assert same_rows(rows(near_terms(index, [ids[1], ids[2]], 4)), [(1, 0), (2, 6)])


def test_rows_that_share_an_id_or_have_none_are_judged_one_by_one(spark):
    item = words(13, 1)
    bad, clean = " ".join(words(187, 3) + item), " ".join(words(3000, 4))
    texts = [(1, bad), (1, bad), (2, bad), (2, clean), (None, bad), (None, bad), (None, clean), (None, None), (3, "")]
    docs, tests = docs_of(spark, texts), items_of(spark, [(7, " ".join(item))])
    got = rows(row_contamination(docs, tests))
    assert same_rows(got, brute(texts, [(7, " ".join(item))]))
    assert sum(r[5] for r in got) == 5


def near_brute(docs, tests, n=13):
    """Items with a window whose rarest word (postings, hash) has all the others within ``n - 1`` words of some place of it."""
    every = [(doc, split(text)) for doc, text in docs]
    known = sorted({x for _, w in every for x in w})
    postings = {x: sum(w.count(x) for _, w in every) for x in known}
    hashed = dict(zip(known, word_hashes(*text_of(pa.array(known)), ALNUM)[0].view(np.int64)))
    out = {doc: set() for doc, _ in docs}
    for item, text in tests:
        w = split(text)
        for i in range(max(1, len(w) - n + 1)) if w else ():
            window = set(w[i : i + n])
            if window <= set(known):
                rarest = min(window, key=lambda x: (postings[x], hashed[x]))
                for doc, d in every:
                    if any(x == rarest and window <= set(d[max(0, k - n + 1) : k + n]) for k, x in enumerate(d)):
                        out[doc].add(item)
    return {doc: len(items) for doc, items in out.items()}


def test_proximity_matches_beside_phrases(spark):
    rng = random.Random(4)
    texts, items = small()
    items = [x for x in items if x[0] is not None]
    for i in range(20, 60):
        part = split(rng.choice(items[:3])[1])[:13] if i % 2 else words(13, i, 8)
        rng.shuffle(part)
        at = rng.randrange(len(part))
        texts.append((i, " ".join(words(30, i) + part[:at] + words(i % 5, i) + part[at:] + words(30, i + 1))))
    items.append((77, " ".join(words(13, 5, 8))))
    got = contamination(docs_of(spark, texts), items_of(spark, items), near=True)
    assert got.columns[-1] == "n_near_items"
    want = near_brute(texts, items)
    assert {r.doc_id: r.n_near_items for r in got.collect()} == want and len(set(want.values())) > 2
    assert same_rows([r[:6] for r in rows(got)], brute(texts, items))
    assert all(r.n_near_items >= r.n_items for r in got.collect())
    alone = row_contamination(docs_of(spark, texts), items_of(spark, items), near=True)
    assert {r.doc_id: r.n_near_items for r in alone.collect()} == want
