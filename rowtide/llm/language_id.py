"""Language identification by partial matching: per-language byte context trees, frozen, score exact code lengths.

A language's tree holds how often each byte followed each context of up to ``ORDER`` bytes. A byte seen after its
longest context costs -log2(count / (total + distinct)); otherwise the escape, -log2(distinct / (total + distinct)), is
paid and the context loses its first byte; below the empty context every byte costs 8 bits. A text's language is the one
whose tree codes all its bytes shortest. Once the counts are frozen, the cost is a function of the last ORDER + 1
bytes, so it is kept per run of bytes for all languages side by side and a text is scored by table look-ups.

Trees are fitted on every labelled text that isn't held out: the runs of all of them are counted, and of each language its
most frequent runs are kept, an equal share of ``ENTRIES``. Only text and label of these rows are learnt.

Which texts are no learnt language is measured: all labelled texts that are held out of the fit are coded by their best
trees, and their bits a byte counted in steps of ``1 / STEPS`` bits. A language's bound is ``TIMES`` the median of these,
but never so low that one in a thousand of the texts held out would go. A text is rejected if its bits exceed the bound of its best language at every byte plus ``ALLOWED`` bits, so that
short texts and those that hold a key, a link or a quotation stay. Labels that are wrong don't move the bound. A language
with fewer than ``ENOUGH`` texts left out has the bound ``REJECT_BITS``.

A text without letters, null or empty, is ``und`` with score 0, as is every text when nothing could be learnt. Equal
code lengths go to the first language by name. A null id is never learnt from and counts as held out. Repeated rows are
scored one by one; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.blocks import blocks, text_of, written

ORDER = 4
ENTRIES = 1 << 20
#: Counts of runs that a task holds before it gives them on.
HELD = 1 << 20
UNKNOWN = "und"
BLOCK = 128 << 10
RAW_BITS = 8.0
#: Bits a byte at which a text is no learnt language where nothing could be measured: what wholly unseen bytes cost.
REJECT_BITS = 16.0
STEPS = 1024
TIMES = 2.0
ALLOWED = 1024.0
ENOUGH = 30


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(True))


def _runs(column: pa.Array, order: int, size: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The last ``order + 1`` bytes at every byte of the lower-cased texts, as one number, ``size`` bytes at a time.

    With each piece, where every row begins in it (the end last). Before a text's first byte stand zero bytes.
    """
    flat, at = text_of(pc.utf8_lower(column))
    wide = np.zeros(len(flat) + order * (len(at) - 1), np.uint8)
    for a in range(0, len(flat), size):
        inside = np.clip(at, a, min(a + size, len(flat))) - a
        place = np.arange(a, a + inside[-1]) + np.repeat(np.arange(1, len(at)) * order, np.diff(inside))
        wide[place] = flat[a : a + size]
        run = np.zeros(inside[-1], np.uint64)
        for back in range(order, -1, -1):
            run = (run << np.uint64(8)) | wide[place - back]
        yield run, inside


class HashTable:
    """Open addressing from 64-bit keys to their places, built and searched in NumPy."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(len(keys) * 2 + 1).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.place = np.full(1 << self.bits, -1, np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.place[slot] < 0
            self.place[slot[free]] = left[free]  # of several for one slot the last stays
            mine = self.place[slot] == left
            self.keys[slot[mine]] = keys[left[mine]]
            left, slot = left[~mine], (slot[~mine] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of the keys, -1 where there is none."""
        slot = self._slot(keys)
        out = self.place[slot]
        other = np.flatnonzero((self.keys[slot] != keys) & (out >= 0))
        out[other] = -1
        slot = slot[other]
        while len(other):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            found = self.place[slot]
            same = (self.keys[slot] == keys[other]) & (found >= 0)
            out[other[same]] = found[same]
            go = ~same & (found >= 0)
            other, slot = other[go], slot[go]
        return out


@dataclass
class Trees:
    """Code lengths of all languages: at each order of the runs that some language has seen, and escapes of contexts."""

    languages: list[str]
    order: int
    keys: list[np.ndarray]
    bits: list[np.ndarray]
    contexts: list[np.ndarray]
    escapes: list[np.ndarray]
    tables: list | None = None
    #: Of each language the bits a byte above which a text is none of it.
    bounds: np.ndarray | None = None

    def __getstate__(self):
        return self.__dict__ | {"tables": None}

    def costs(self, runs: np.ndarray) -> np.ndarray:
        """Bits of the last byte of each run, in each language."""
        if self.tables is None:
            self.tables = [(HashTable(k), HashTable(c)) for k, c in zip(self.keys, self.contexts)]
        return self._costs(runs, self.order)

    def _costs(self, runs: np.ndarray, order: int) -> np.ndarray:
        if order < 0:
            return np.full((len(runs), len(self.languages)), RAW_BITS, np.float32)
        runs = runs & np.uint64((1 << 8 * (order + 1)) - 1)
        grams, contexts = self.tables[order]
        place = grams.find(runs)
        out = self.bits[order][place]
        lost = np.flatnonzero(place < 0)
        if len(lost):
            left = runs[lost]
            context = contexts.find(left >> np.uint64(8))
            out[lost] = self._costs(left, order - 1) + np.where((context >= 0)[:, None], self.escapes[order][context], np.float32(0))
        return out


def labelled(docs: DataFrame, out: bool = False) -> DataFrame:
    """``lang, text`` of all rows with both that may be learnt from, or with ``out`` of those held out."""
    mine = held_out(F.col("doc_id")) if out else ~held_out(F.col("doc_id"))
    return docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & mine).select("lang", "text")


def _together(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several counts of runs as one."""
    run, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(run, kind="stable")
    run, n = run[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.zeros(0, np.int64)
    return run[first], np.add.reduceat(n, first) if len(first) else n


def run_counts(texts: DataFrame, order: int) -> DataFrame:
    """``lang, run, n`` over all bytes of ``lang, text`` rows; a task adds up at most about ``HELD`` counts before they go on."""

    def given(held):
        for lang, counts in held.items():
            run, n = _together(counts)
            for a in range(0, len(run), 1 << 16):
                part = run[a : a + (1 << 16)].view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(part)), pa.array(part), pa.array(n[a : a + (1 << 16)])], names=["lang", "run", "n"])

    def count(batches):
        held, size = {}, 0
        for batch in batches:
            for part in blocks(batch, limit=BLOCK):
                names = part.column(0)
                for lang in pc.unique(names).to_pylist():
                    for runs, _ in _runs(part.column(1).filter(pc.equal(names, lang)), order):
                        run, n = np.unique(runs, return_counts=True)
                        held.setdefault(lang, []).append((run, n.astype(np.int64)))
                        size += len(run)
                if size > HELD:
                    held = {lang: [_together(counts)] for lang, counts in held.items()}
                    size = sum(len(counts[0][0]) for counts in held.values())
                if size > HELD // 2:
                    yield from given(held)
                    held, size = {}, 0
        yield from given(held)

    return texts.mapInArrow(count, "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))


def _reached(rows: DataFrame, by: Column, need: Column) -> DataFrame:
    """``lang, at, left``: the value of ``by`` at which each language has ``need`` rows, from the least value on, and how many
    are wanted of those with that value. Rows are counted by value first; a language with fewer rows isn't listed."""
    counts = rows.groupBy("lang", by.alias("at")).agg(F.count("*").alias("rows"), F.max(need).alias("need"))
    upto = F.sum("rows").over(Window.partitionBy("lang").orderBy("at"))
    reached = counts.withColumn("upto", upto).where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("rows") < F.col("need")))
    return reached.select("lang", "at", (F.col("need") - F.col("upto") + F.col("rows")).alias("left"))


def frequent(counts: DataFrame, entries: int) -> DataFrame:
    """Of each language its most frequent runs, an equal share of ``entries``; ties to the smaller run.

    Only counts of runs by their frequency, and of the last frequency's by their first bytes, are put in order: no task
    sorts a language's runs.
    """
    share = entries // max(1, counts.agg(F.count_distinct("lang")).first()[0])
    if not share:
        return counts.select("lang", "run", "n").limit(0)
    last = _reached(counts, -F.col("n"), F.lit(share)).withColumn("least", -F.col("at")).drop("at")
    placed = counts.join(F.broadcast(last), "lang", "left")
    tied = placed.where(F.col("n") == F.col("least"))
    start = F.shiftright("run", 24)
    open_ = tied.join(F.broadcast(_reached(tied, start, F.col("left")).withColumnRenamed("left", "few")), "lang")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("run"))
    ends = open_.where(start == F.col("at")).withColumn("rank", rank).where(F.col("rank") <= F.col("few"))
    parts = [placed.where(F.col("least").isNull() | (F.col("n") > F.col("least"))), open_.where(start < F.col("at")), ends]
    return parts[0].select("lang", "run", "n").union(parts[1].select("lang", "run", "n")).union(parts[2].select("lang", "run", "n"))


def fit(docs: DataFrame, order: int = ORDER, entries: int = ENTRIES) -> Trees:
    """Trees from all labelled rows of ``doc_id, text, lang`` that aren't held out; the driver gets at most ``entries`` counts."""
    counts = written(run_counts(labelled(docs), order), "runs")
    best = frequent(counts, entries).toArrow().combine_chunks()
    languages = sorted(set(best.column("lang").to_pylist()))
    code = {x: i for i, x in enumerate(languages)}
    lang = np.array([code[x] for x in best.column("lang").to_pylist()], np.int64)
    run, n = np.asarray(best.column("run"), np.int64).view(np.uint64), np.asarray(best.column("n"), np.float64)
    full, known, contexts, escapes = [], [], [], []
    for k in range(order + 1):
        keys, place = np.unique(run & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
        count = np.zeros((len(keys), len(languages)))
        np.add.at(count, (place, lang), n)
        context, above = np.unique(keys >> np.uint64(8), return_inverse=True)
        total, distinct = np.zeros((2, len(context), len(languages)))
        np.add.at(total, above, count)
        np.add.at(distinct, above, count > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0)
            seen = -np.log2(count / (total + distinct)[above])
        if k:
            below = full[-1][np.searchsorted(known[-1], keys & np.uint64((1 << 8 * k) - 1))]
        else:
            below = np.full_like(seen, RAW_BITS)
        full.append(np.where(count > 0, seen, escape[above] + below).astype(np.float32))
        known.append(keys)
        contexts.append(context)
        escapes.append(escape.astype(np.float32))
    return Trees(languages, order, known, full, contexts, escapes)


def code_lengths(model: Trees, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each lower-cased text and its bits in each language."""
    bits = np.zeros((len(text), len(model.languages)))
    for runs, inside in _runs(text, model.order):
        some = np.diff(inside) > 0
        bits[some] += np.add.reduceat(model.costs(runs), inside[:-1][some], axis=0, dtype=np.float64)
    return np.asarray(pc.binary_length(pc.utf8_lower(text)), np.int64), bits


def lettered(text: pa.Array) -> np.ndarray:
    return np.asarray(pc.match_substring_regex(text, r"\p{L}"), bool)


def fit_bounded(docs: DataFrame, order: int = ORDER, entries: int = ENTRIES) -> Trees:
    """Trees of ``fit``, with the languages' bounds measured on all labelled texts that are held out of it."""
    trees = fit(docs, order, entries)
    if not trees.languages:
        return trees
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def measure(batches):
        for batch in batches:
            for part in blocks(batch, limit=BLOCK):
                text = part.column(1).filter(pa.array(lettered(part.column(1))))
                size, bits = code_lengths(shared.value, text)
                own = bits.argmin(1)
                best = bits.min(1)
                steps = [np.clip(np.floor(x / size * STEPS), 0, REJECT_BITS * STEPS).astype(np.int64) for x in (best, best - ALLOWED)]
                yield pa.RecordBatch.from_arrays([pa.array(own), *map(pa.array, steps)], names=["own", "best", "least"])

    left = labelled(docs, out=True).mapInArrow(measure, "own long, best long, least long")
    counts = left.groupBy("own", "best", "least").agg(F.count("*").alias("n"))
    either = F.inline(F.array(*[F.struct(F.lit(x).alias("what"), F.col(x).alias("step")) for x in ("best", "least")]))
    steps = counts.select("own", "n", either).groupBy("own", "what", "step").agg(F.sum("n").alias("n"))
    each = Window.partitionBy("own", "what")
    steps = steps.withColumns({"upto": F.sum("n").over(each.orderBy("step")), "of": F.sum("n").over(each)}).where(F.col("of") >= ENOUGH)
    part = F.when(F.col("what") == "best", 0.5).otherwise(0.999)
    edges = steps.where(F.col("upto") >= part * F.col("of")).groupBy("own").agg(*[F.min(F.when(F.col("what") == x, F.col("step") + 1)).alias(x) for x in ("best", "least")])
    trees.bounds = np.full(len(trees.languages), REJECT_BITS)
    for row in edges.toLocalIterator():
        trees.bounds[row.own] = min(REJECT_BITS, max(TIMES * row.best, row.least) / STEPS)
    return trees


def score_texts(model: Trees, text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the best language's place (the number of languages: unknown), its share and its bits a byte."""
    known = lettered(text) & bool(model.languages)
    best, share, each = np.full(len(known), len(model.languages)), np.zeros(len(known)), np.zeros(len(known))
    if known.any():
        size, bits = code_lengths(model, text.filter(pa.array(known)))
        best[known] = bits.argmin(1)
        share[known] = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
        each[known] = bits.min(1) / size
    return best, share, each


def identify(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, bits_per_byte``: the score is the best language's share of 2 ** -bits."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def score(batches):
        names = pa.array([*shared.value.languages, UNKNOWN])
        for batch in batches:
            for part in blocks(batch, limit=BLOCK):
                best, share, each = score_texts(shared.value, pc.fill_null(part.column(1), ""))
                yield pa.RecordBatch.from_arrays([part.column(0), names.take(pa.array(best)), pa.array(share), pa.array(each)], names=["doc_id", "lang_pred", "score", "bits_per_byte"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double, bits_per_byte double")


def keep_known(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """The rows whose text has a letter and is some learnt language by the bounds of the trees; same columns.

    Trees without bounds reject texts of ``REJECT_BITS`` a byte or more. Where nothing could be learnt, every text with a
    letter stays.
    """
    place = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def keep(batches):
        for batch in batches:
            for part in blocks(batch, text_col, BLOCK):
                model, text = shared.value, pc.fill_null(part.column(place), "")
                best, _, each = score_texts(model, text)
                known = best < len(model.languages) if model.languages else lettered(text)
                stays = each < REJECT_BITS
                if model.bounds is not None:
                    size = np.maximum(np.asarray(pc.binary_length(pc.utf8_lower(text)), np.int64), 1)
                    bound = np.append(model.bounds, REJECT_BITS)[best]
                    stays &= (bound >= REJECT_BITS) | (each * size <= bound * size + ALLOWED)
                yield part.filter(pa.array(known & stays))

    return docs.mapInArrow(keep, docs.schema)
