"""Benchmark passages in training documents, found through a distributed positional inverted index.

The index holds postings (term, document, position) of the test windows' rarest terms, written as a table. A window's
lists are intersected from its rarest term on: every posting of that term, moved back by the term's offset, is a
candidate start, and each further list keeps those that have its term at the offset asked for. A candidate counts when
all words of the window stand there in order. Which terms are rare is counted over all documents. Postings of a first
term carry the words around them, so that the last comparison reads no text again.

With ``near``, proximity matches are counted beside the phrases: places of a window's rarest term with all other words of
the window within ``words - 1`` words of it, in any order. They are read off the same postings.

Terms are 64-bit hashes of lower-cased words. The vocabulary of the tests reaches the tasks in blocks of at most
``BLOCK_TERMS`` terms (8 bytes each); a larger one takes more passes over the documents.

Null and empty texts have no words; an item without words has no window. ``contamination`` reads rows that share an id
as one document, rows without an id likewise; ``row_contamination`` judges each row by itself, through a hash of its id
and text (equal rows are judged once). Empty tables give no rows, or rows without hits.
Columns other than the named ones are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from rowtide.llm.blocks import ALNUM, blocks, fresh, ragged, text_of, word_hashes, written

WORDS = 13
LISTS = 3
BLOCK_TERMS = 1 << 20
SHARE = 20


def _rows(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return table.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))


def item_windows(tests: DataFrame, id_col: str = "item_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``item_id, window, terms``: every run of ``words`` words; an item of fewer is one window."""

    def cut(batches):
        for batch in batches:
            for part in blocks(batch):
                hashes, before = word_hashes(*text_of(part.column(1)), ALNUM)
                n = np.diff(before)
                count = np.where(n == 0, 0, np.maximum(1, n - words + 1))
                row = np.repeat(np.arange(len(n)), count)
                begin = ragged(before[:-1], count)
                length = np.minimum(n, words)[row]
                terms = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32)), pa.array(hashes[ragged(begin, length)].view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), terms], names=["item_id", "terms"])

    cuts = _rows(tests, id_col, text_col).mapInArrow(cut, "item_id long, terms array<long>")
    return cuts.select("item_id", F.xxhash64("terms").alias("window"), "terms").distinct()


def _term_blocks(terms: DataFrame, limit: int) -> list[np.ndarray]:
    """The distinct terms as sorted arrays of bounded size; only one of them is in use at a time."""
    n = terms.count()
    parts = max(1, -(-n * 5 // (limit * 4)))
    for k in range(parts):
        block = terms.where(F.pmod("term", F.lit(parts)) == k) if parts > 1 else terms
        yield np.sort(np.asarray(block.toArrow().column("term").combine_chunks(), np.int64))


def _places(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where the words that ``table`` (sorted) holds stand."""
    if not len(table):
        return np.zeros(0, np.int64)
    # A bitmap of 16 hash bits lets most other words go before the search.
    seen = np.zeros(1 << 16, bool)
    seen[table & 0xFFFF] = True
    at = np.flatnonzero(seen[hashes & 0xFFFF])
    found = np.minimum(np.searchsorted(table, hashes[at]), len(table) - 1)
    return at[table[found] == hashes[at]]


def term_counts(docs: DataFrame, terms: DataFrame, limit: int = BLOCK_TERMS) -> DataFrame:
    """``term, postings``: how often each asked-for term stands in the documents."""

    def counter(table):
        def count(batches):
            total = np.zeros(len(table), np.int64)
            for batch in batches:
                for part in blocks(batch):
                    hashes = word_hashes(*text_of(part.column(1)), ALNUM)[0].view(np.int64)
                    total += np.bincount(np.searchsorted(table, hashes[_places(hashes, table)]), minlength=len(table))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(table[at]), pa.array(total[at])], names=["term", "n"])

        return count

    counted = [docs.mapInArrow(counter(table), "term long, n long") for table in _term_blocks(terms, limit)]
    return reduce(DataFrame.union, counted).groupBy("term").agg(F.sum("n").alias("postings"))


def rarest_terms(windows: DataFrame, counts: DataFrame, lists: int = LISTS) -> DataFrame:
    """``window, terms, rare``: the ``lists`` rarest (postings, offset, term) of each window that can occur at all."""
    placed = windows.select("window", "terms").dropDuplicates(["window"]).select("window", "terms", F.posexplode("terms").alias("at", "term"))
    rare = F.slice(F.sort_array(F.collect_list(F.struct("postings", "term", "at"))), 1, lists)
    full = placed.join(counts, "term").groupBy("window").agg(F.first("terms").alias("terms"), F.count("*").alias("n"), rare.alias("rare"))
    return full.where(F.col("n") == F.size("terms")).drop("n")


def postings(docs: DataFrame, terms: DataFrame, firsts: DataFrame, words: int = WORDS, limit: int = BLOCK_TERMS) -> DataFrame:
    """The index: ``term, doc_id, at, around`` of each of the terms. ``around`` has the ``2 * words - 1`` words about the
    posting (0 beyond the text) for terms in ``firsts``. The first block also gives each document's ``n_words`` (term null).
    """
    schema = "term long, doc_id long, at int, around array<long>, n_words long"
    names = schema.replace(",", "").split()[::2]
    near = np.arange(-(words - 1), words)

    def lister(table, with_context, with_size):
        def listed(batches):
            for batch in batches:
                for part in blocks(batch):
                    hashes, before = word_hashes(*text_of(part.column(1)), ALNUM)
                    hashes, n = hashes.view(np.int64), np.diff(before)
                    if with_size:
                        nulls = [pa.nulls(len(n), t) for t in (pa.int64(), pa.int32(), pa.list_(pa.int64()))]
                        yield pa.RecordBatch.from_arrays([nulls[0], part.column(0), *nulls[1:], pa.array(n.astype(np.int64))], names=names)
                    every = _places(hashes, table)
                    for a in range(0, len(every), 20_000):
                        at = every[a : a + 20_000]
                        row = np.searchsorted(before, at, "right") - 1
                        first = with_context[np.searchsorted(table, hashes[at])]
                        from_ = at[first][:, None] + near
                        inside = (from_ >= before[row[first]][:, None]) & (from_ < before[row[first] + 1][:, None])
                        around = np.where(inside, hashes[np.where(inside, from_, 0)], 0)
                        starts = np.concatenate([[0], np.cumsum(first * len(near))]).astype(np.int32)
                        lists = pa.ListArray.from_arrays(pa.array(starts), pa.array(around.ravel()))
                        yield pa.RecordBatch.from_arrays([pa.array(hashes[at]), part.column(0).take(pa.array(row)), pa.array((at - before[row]).astype(np.int32)), lists, pa.nulls(len(at), pa.int64())], names=names)

        return listed

    out = []
    for k, table in enumerate(_term_blocks(terms, limit)):
        with_context = np.zeros(len(table), bool)
        for own in _term_blocks(firsts, limit):
            with_context[np.searchsorted(table, np.intersect1d(own, table, assume_unique=True))] = True
        out.append(docs.mapInArrow(lister(table, with_context, k == 0), schema))
    return reduce(DataFrame.union, out)


def occurrences(index: DataFrame, windows: DataFrame, words: int = WORDS, lists: int = LISTS) -> DataFrame:
    """``window, doc_id, at, n``: each place where all words of a window (``rarest_terms``) stand in order."""
    first = F.col("rare")[0]
    asked = windows.select("window", "terms", "rare", first["term"].alias("term"), first["at"].alias("offset"))
    found = index.where(F.col("around").isNotNull()).join(asked, "term").withColumn("at", F.col("at") - F.col("offset")).where(F.col("at") >= 0)
    found = found.where(F.slice("around", words - F.col("offset"), F.size("terms")) == F.col("terms")) if lists <= 1 else found
    for k in range(1, lists):
        more = index.where(F.col("term").isNotNull()).select(F.col("term").alias("t"), F.col("doc_id").alias("d"), F.col("at").alias("a"))
        have = F.size("rare") > k
        kept = found.where(have).withColumn("next", F.col("rare")[k])
        kept = kept.join(more, (F.col("next.term") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("at") + F.col("next.at") == F.col("a")), "left_semi").drop("next")
        found = found.where(~have).unionByName(kept)
    found = found.where(F.slice("around", words - F.col("offset"), F.size("terms")) == F.col("terms"))
    return found.select("window", "doc_id", "at", F.size("terms").alias("n")).distinct()


def proximity(index: DataFrame, windows: DataFrame) -> DataFrame:
    """``window, doc_id, at``: postings of a window's rarest term (``rarest_terms``) that have all its words around them."""
    asked = windows.select("window", "terms", "rare", F.col("rare")[0]["term"].alias("term"))
    found = index.where(F.col("around").isNotNull()).join(asked, "term")
    second = F.coalesce(F.array_contains("around", F.get("rare", F.lit(1))["term"]), F.lit(True))
    return found.where(second & (F.size(F.array_except("terms", "around")) == 0)).select("window", "doc_id", "at").distinct()


def near_terms(index: DataFrame, terms: list[int], span: int) -> DataFrame:
    """Proximity: ``doc_id, at``: places from where ``span`` words hold all the terms, in any order (``index`` of all of them)."""
    asked = index.where(F.col("term").isin(terms)).select("doc_id", "at", "term")
    ahead = W.partitionBy("doc_id").orderBy("at").rangeBetween(0, span - 1)
    return asked.withColumn("n", F.size(F.collect_set("term").over(ahead))).where(F.col("n") == len(set(terms))).select("doc_id", "at").distinct()


def contamination(docs: DataFrame, tests: DataFrame, words: int = WORDS, lists: int = LISTS, share: int = SHARE, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", limit: int = BLOCK_TERMS, near: bool = False) -> DataFrame:
    """Per document ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``, with ``near`` also ``n_near_items``.

    A word inside any occurrence of a window is hit; a document is contaminated when ``share * n_hit >= n_words > 0``
    with at least one hit. ``n_near_items`` counts the items with a proximity match, which decides nothing.
    """
    return _judged(_rows(docs, doc_id, doc_text), tests, F.sum, words, lists, share, item_id, item_text, limit, near)


def row_key(id_col: str = "doc_id", text_col: str = "text"):
    """A key that only rows with equal id and text share."""
    return F.xxhash64(F.col(id_col).cast("long"), F.col(text_col).cast("string"))


def judged_rows(docs: DataFrame, tests: DataFrame, words: int = WORDS, lists: int = LISTS, share: int = SHARE, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", limit: int = BLOCK_TERMS, near: bool = False) -> DataFrame:
    """As ``contamination``, per distinct row: ``row_key`` in place of ``doc_id``."""
    rows = docs.select(row_key(doc_id, doc_text).alias("id"), F.col(doc_text).cast("string").alias("text"))
    return _judged(rows, tests, F.max, words, lists, share, item_id, item_text, limit, near).withColumnRenamed("doc_id", "row_key")


def row_contamination(docs: DataFrame, tests: DataFrame, words: int = WORDS, lists: int = LISTS, share: int = SHARE, doc_id: str = "doc_id", doc_text: str = "text", item_id: str = "item_id", item_text: str = "text", limit: int = BLOCK_TERMS, near: bool = False) -> DataFrame:
    """As ``contamination``, but one result for each row, whether or not others have its id."""
    own = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, doc_text).alias("row_key"))
    return own.join(judged_rows(docs, tests, words, lists, share, doc_id, doc_text, item_id, item_text, limit, near), "row_key").drop("row_key")


def without_contaminated(docs: DataFrame, tests: DataFrame, doc_id: str = "doc_id", doc_text: str = "text") -> DataFrame:
    """The rows that are not contaminated, with all their columns; each is judged by its own text."""
    own = fresh(docs, "bad_key")
    bad = judged_rows(docs, tests, doc_id=doc_id, doc_text=doc_text).where("contaminated").select(F.col("row_key").alias(own))
    return docs.join(bad, row_key(doc_id, doc_text) == F.col(own), "left_anti")


def _items(places: DataFrame, windows: DataFrame) -> DataFrame:
    """``doc_id, item_id`` of the windows that stand somewhere in a document."""
    return places.select("doc_id", "window").distinct().join(windows.select("window", "item_id"), "window").select("doc_id", "item_id").distinct()


def _judged(rows: DataFrame, tests: DataFrame, size, words: int, lists: int, share: int, item_id: str, item_text: str, limit: int, near: bool) -> DataFrame:
    """The columns of ``contamination`` for each id of ``id, text`` rows; ``size`` makes one word count of an id's several."""
    windows = written(item_windows(tests, item_id, item_text, words), "windows")
    vocabulary = windows.select(F.explode("terms").alias("term")).distinct()
    rare = written(rarest_terms(windows, term_counts(rows, vocabulary, limit), lists), "rarest")
    index_terms = rare.select(F.explode("rare.term").alias("term")).distinct()
    index = written(postings(rows, index_terms, rare.select(F.col("rare")[0]["term"].alias("term")).distinct(), words, limit), "postings")
    found = written(occurrences(index, rare, words, lists), "occurrences")

    before = W.partitionBy("doc_id").orderBy("at", "n").rowsBetween(W.unboundedPreceding, -1)
    end = F.col("at") + F.col("n")
    covered = F.greatest(F.lit(0), end - F.greatest("at", F.coalesce(F.max(end).over(before), F.lit(0))))
    hit = found.select("doc_id", "at", "n").distinct().withColumn("new", covered).groupBy("doc_id").agg(F.sum("new").alias("n_hit"))
    listed = _items(found, windows).groupBy("doc_id").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list(F.col("item_id").cast("string"))), ",").alias("listed"))
    sizes = index.where(F.col("term").isNull()).groupBy("doc_id").agg(size("n_words").alias("n_words"))

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("doc_id", "own")
        return left.join(right, left.doc_id.eqNullSafe(right.own), "left").drop("own")

    n_hit, n_items = F.coalesce("n_hit", F.lit(0)).cast(T.LongType()), F.coalesce("n_items", F.lit(0))
    judged = beside(beside(sizes, hit), listed)
    close = []
    if near:
        judged = beside(judged, _items(proximity(index, rare), windows).groupBy("doc_id").agg(F.count("*").alias("n_near_items")))
        close = [F.coalesce("n_near_items", F.lit(0)).alias("n_near_items")]
    return judged.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        n_items.alias("n_items"),
        F.sha2(F.coalesce("listed", F.lit("")).cast("binary"), 256).alias("items_sha256"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"),
        *close,
    )
