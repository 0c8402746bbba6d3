import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import types as T

from rowtide.frames import small_frame
from rowtide.llm import lexical_search as ls
from tests.llm.data import docs_of, odd_texts, rows, same_rows, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("query", T.StringType()), T.StructField("rank", T.StringType())])


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k):
    """Every document scored for every query, by the definition."""
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, w) for i, w in held if w]
    n_docs, length = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, w in held:
            m = 75 + 25 * len(w) * n_docs // length
            score = 0
            for t in terms(text):
                if t in df and t in w:
                    tf = w.count(t)
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * tf // (1000 * tf + 12 * m))
            if score:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def items_of(spark, items):
    return small_frame(spark, [(*x, "a", "b") for x in items], ITEM)


ITEMS = [(1, "w1 w2 W3 w3 w250"), (1, "w1 w2 W3 w3 w250"), (None, "one words"), (3, None), (4, "?!"), (5, "unheard of"), (6, "日本語 İSTANBUL"), (7, " ".join(f"w{i}" for i in range(400)))]


def test_odd_texts(spark):
    docs = odd_texts()
    got = ls.search(docs_of(spark, docs), items_of(spark, ITEMS))
    assert same_rows(rows(got), plain_search(docs, ITEMS, 20))


@pytest.mark.parametrize("shard, window, block", [(1 << 20, 1 << 13, 1 << 20), (300, 16, 50), (2000, 4, 200)])
def test_skipping_loses_nothing(spark, monkeypatch, shard, window, block):
    """Zipf-like words, many equal scores, hundreds of documents: small shards and windows, blocks of queries."""
    rng = random.Random(9)
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(3000)]
    docs = [(i // 2, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 30, 80])))) for i in range(400)]
    items = [(q, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12, 60])))) for q in range(25)]
    monkeypatch.setattr(ls, "SHARD", shard)
    monkeypatch.setattr(ls, "WINDOW", window)
    got = ls.search(docs_of(spark, docs), items_of(spark, items), k=7, block_text=block)
    assert same_rows(rows(got), plain_search(docs, items, 7))


def test_idle_lists_are_only_looked_up():
    """A common term that can't reach the bar on its own brings no documents, but counts where others do."""
    n = np.full(3000, 4)
    before = np.concatenate([[0], np.cumsum([2 if d < 30 else 1 for d in range(3000)])])
    held = np.concatenate([[0, 1] if d < 30 else [0] for d in range(3000)])
    shard = ls.Shard(n, before, held, np.ones(len(held), np.int64), np.array([5, 4000]), 3000, 12000)
    found, scores = shard.best(np.array([0, 1]), np.array([1, 1]), np.arange(3000), 20)
    assert found.tolist() == list(range(20)) and len(set(scores.tolist())) == 1
    assert scores[0] == (5 + 4000) * (1_000_000_000 // (1000 + 12 * 100))


def test_empty_tables(spark):
    docs = table(spark, "documents")
    assert rows(ls.search(docs.limit(0), table(spark, "benchmark"))) == []
    empty = ls.search(docs, table(spark, "benchmark").limit(0))
    assert rows(empty) == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]
