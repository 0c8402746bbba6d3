"""Ranked lexical search of all documents for a set of queries, term-at-a-time and document-at-a-time together.

A document's score is the sum of ``w * ((1000000000 * tf) div (1000 * tf + 12 * m))`` over the query's terms, repeats
included, with ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 75 + (25 * n * N) div L``; N documents with a term,
L their terms, n a document's terms, df the documents that hold the term. All but w is 64-bit integer.

1. Each block of queries (``BLOCK_TEXT`` bytes of query text, so what is broadcast is bounded) makes one pass over the
   documents: a row per document with its length and the query terms it holds, written as a table. N, L and df are
   aggregated from that table.
2. Shards of that table (``SHARD`` postings) turn their rows into posting lists with impacts. For each query the short
   lists are summed term at a time, and the sums become one more iterator with their greatest sum as its bound. It and the
   long lists are then walked document by document in windows: the k-th best score so far is the bar, lists that together
   stay below the bar bring no document of their own, and are only looked up where a document's sum and what is left can
   still reach the bar. The k-th greatest of the summed accumulators is a bar to begin with.
3. The best k of every shard meet in a window over the query, which keeps k rows of a query on each side of its shuffle.

A skipped document is strictly below k others of its shard, so the results are those of scoring everything; equal scores
go by id. Term hashes have 64 bits and are not compared with the words themselves.

Null texts have no terms; documents without a term count nowhere, and queries without one give no rows. Each query row is
ranked for itself, rows that share an id or have none too, and each document row is a document of its own; null ids rank
last among equal scores. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rowtide.frames import small_frame
from rowtide.llm.blocks import ALNUM, blocks, ragged, text_of, word_hashes, written

K = 20
BLOCK_TEXT = 4 << 20
SHARD = 3 << 20
WINDOW = 1 << 13
SHORT = 8  # lists are summed up front while together they hold at most an eighth of the shard's documents


@dataclass
class Queries:
    """A block of queries: sorted distinct term hashes, and per query its terms (numbers) with their repeats."""

    ids: list
    terms: np.ndarray
    before: np.ndarray
    which: np.ndarray
    repeats: np.ndarray


def query_block(ids: list, texts: list[str | None]) -> Queries:
    flat, at = text_of(pa.array(texts, pa.string()))
    words, before = word_hashes(flat, at, ALNUM)
    terms, which = np.unique(words, return_inverse=True)
    row = np.repeat(np.arange(len(ids)), np.diff(before))
    pairs, repeats = np.unique(row * max(1, len(terms)) + which, return_counts=True)
    row = pairs // max(1, len(terms))
    return Queries(ids, terms, np.searchsorted(row, np.arange(len(ids) + 1)), pairs % max(1, len(terms)), repeats)


def query_blocks(items: DataFrame, limit: int = BLOCK_TEXT) -> Iterator[Queries]:
    """The queries in blocks of about ``limit`` bytes of text (or one longer query), a partition of them at a time."""
    ids, texts, size = [], [], 0
    for row in items.toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len((row[1] or "").encode()) + 64
        if size >= limit:
            yield query_block(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield query_block(ids, texts)


def held_terms(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, tfs`` of each document with a term: its length and the listed terms it holds."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        known = shared.value
        for batch in batches:
            for part in blocks(batch):
                flat, at = text_of(part.column(1))
                words, before = word_hashes(flat, at, ALNUM)
                place = np.minimum(np.searchsorted(known, words), max(0, len(known) - 1))
                hit = known[place] == words if len(known) else np.zeros(len(words), bool)
                row = np.repeat(np.arange(part.num_rows), np.diff(before))
                pairs, tf = np.unique(row[hit] * len(known) + place[hit], return_counts=True)
                some = np.flatnonzero(np.diff(before) > 0)
                edge = np.searchsorted(pairs // max(1, len(known)), np.arange(part.num_rows + 1))
                # pairs are in row order and rows without a term hold none
                cuts = pa.array(np.append(edge[some], edge[-1]).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x.astype(np.int32))) for x in (pairs % max(1, len(known)), tf)]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(some)), pa.array(np.diff(before)[some]), *lists], names=["doc_id", "n", "terms", "tfs"])

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


class Shard:
    """Posting lists of some documents, each in document order, with the impact of every posting."""

    def __init__(self, n: np.ndarray, before: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weight: np.ndarray, documents: int, length: int):
        self.size = len(n)
        order = np.argsort(terms, kind="stable")
        doc = np.repeat(np.arange(len(n), dtype=np.int32), np.diff(before))[order]
        norm = 12 * (75 + (25 * n * documents) // max(1, length))
        tf = tfs[order].astype(np.int64)
        self.doc = doc
        self.impact = weight[terms[order]] * ((1_000_000_000 * tf) // (1000 * tf + norm[doc]))
        self.edge = np.searchsorted(terms[order], np.arange(len(weight) + 1))
        self.most = np.zeros(len(weight), np.int64)
        some = np.flatnonzero(np.diff(self.edge))
        if len(some):
            self.most[some] = np.maximum.reduceat(self.impact, self.edge[some])

    def accumulated(self, terms: np.ndarray, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of these lists and the sums of their impacts."""
        length = self.edge[terms + 1] - self.edge[terms]
        at = ragged(self.edge[terms], length)
        doc, which = np.unique(self.doc[at], return_inverse=True)
        total = np.zeros(len(doc), np.int64)
        np.add.at(total, which, self.impact[at] * np.repeat(repeats, length))
        return doc, total

    def best(self, terms: np.ndarray, repeats: np.ndarray, rank: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best documents and their scores, ties by ``rank``; all others score less or rank behind."""
        length = self.edge[terms + 1] - self.edge[terms]
        order = np.argsort(length, kind="stable")
        order = order[(length[order] > 0) & (self.most[terms[order]] > 0)]
        terms, repeats, length = terms[order], repeats[order], length[order]
        n_short = int(np.searchsorted(np.cumsum(length), self.size // SHORT, "right"))
        # Iterators: (documents, scores, repeats, bound); the sums of the short lists are one of them.
        lists = [(self.doc[a:b], self.impact[a:b], int(r), int(r) * int(self.most[t])) for t, r in zip(terms[n_short:], repeats[n_short:]) for a, b in [(self.edge[t], self.edge[t + 1])]]
        bar = 1
        if n_short:
            doc, total = self.accumulated(terms[:n_short], repeats[:n_short])
            lists.append((doc, total, 1, int(total.max())))
            if len(total) >= k:
                bar = max(bar, int(np.partition(total, len(total) - k)[len(total) - k]))
        lists.sort(key=lambda x: x[3])
        up_to = np.cumsum([x[3] for x in lists])
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for low in range(0, self.size, WINDOW):
            # lists [0, idle) together stay below the bar
            idle = int(np.searchsorted(up_to, bar, "left"))
            if idle == len(lists):
                break
            high = min(low + WINDOW, self.size)
            sums = np.zeros(high - low, np.int64)
            for doc, impact, times, _ in lists[idle:]:
                a, b = np.searchsorted(doc, (low, high))
                sums[doc[a:b] - low] += impact[a:b] * times
            here = np.flatnonzero(sums)
            total = sums[here]
            for j in range(idle - 1, -1, -1):
                stay = total + up_to[j] >= bar
                here, total = here[stay], total[stay]
                if not len(here):
                    break
                doc, impact, times, _ = lists[j]
                at = np.minimum(np.searchsorted(doc, here + low), len(doc) - 1)
                total = total + np.where(doc[at] == here + low, impact[at] * times, 0)
            stay = total >= bar
            if stay.any():
                found, scores = np.concatenate([found, here[stay] + low]), np.concatenate([scores, total[stay]])
                if len(found) > k:
                    first = np.lexsort((rank[found], -scores))[:k]
                    found, scores = found[first], scores[first]
                if len(found) == k:
                    bar = max(bar, int(scores.min()))
        return found, scores


def shard_results(index: DataFrame, queries: Queries, weight: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    """``query, doc_id, score``: the k best of every shard for every query of the block."""
    shared = index.sparkSession.sparkContext.broadcast((queries.before, queries.which, queries.repeats, weight))

    def answers(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        before, which, repeats, w = shared.value
        rows = pa.Table.from_batches(held).combine_chunks()
        terms, tfs = (rows.column(c).combine_chunks() if rows.column(c).num_chunks != 1 else rows.column(c).chunk(0) for c in ("terms", "tfs"))
        n = rows.column("n").to_numpy()
        edge = np.concatenate([[0], np.cumsum(np.asarray(terms.value_lengths(), np.int64))])
        shard = Shard(n, edge, np.asarray(terms.flatten()), np.asarray(tfs.flatten()), w, documents, length)
        ids = rows.column("doc_id")
        rank = np.empty(len(n), np.int64)
        rank[np.asarray(pc.sort_indices(ids, null_placement="at_end"))] = np.arange(len(n))
        query, doc, score = [], [], []
        for q in range(len(before) - 1):
            mine = slice(before[q], before[q + 1])
            found, scores = shard.best(which[mine], repeats[mine], rank, k)
            query.append(np.full(len(found), q, np.int64))
            doc.append(found)
            score.append(scores)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(query)), ids.take(pa.array(np.concatenate(doc))).combine_chunks(), pa.array(np.concatenate(score))], names=["query", "doc_id", "score"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            # by far the longest rows are cut off a batch of their own
            edge = np.cumsum(np.asarray(batch.column(2).value_lengths(), np.int64) + 1)
            at = 0
            while at < batch.num_rows:
                end = max(at + 1, int(np.searchsorted(edge, (edge[at - 1] if at else 0) + SHARD - size, "right")))
                held.append(batch.slice(at, end - at))
                size += int(edge[end - 1] - (edge[at - 1] if at else 0))
                at = end
                if size >= SHARD or at < batch.num_rows:
                    yield answers(held)
                    held, size = [], 0
        if held:
            yield answers(held)

    return index.mapInArrow(run, "query long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_text: int = BLOCK_TEXT) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best documents of each query row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    spark, kind = docs.sparkSession, asked.schema["item_id"].dataType
    parts = []
    for queries in query_blocks(asked, block_text):
        index = written(held_terms(rows, queries.terms), "term-index")
        total = index.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
        df = np.zeros(len(queries.terms), np.int64)
        for r in index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
            df[r["term"]] = r["df"]
        weight = np.array([math.floor(1000 * math.log((2 * total["n"] + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        found = shard_results(index, queries, weight, total["n"], total["l"], k)
        place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
        best = found.withColumn("rank", place).where(F.col("rank") <= k)
        names = small_frame(spark, enumerate(queries.ids), T.StructType([T.StructField("query", T.LongType()), T.StructField("item_id", kind)]))
        parts.append(written(best.join(names, "query").select("item_id", "rank", "doc_id", "score"), "search"))
    if not parts:
        return small_frame(spark, [], T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    return reduce(DataFrame.unionByName, parts)
