"""Quality rules whose thresholds come from mergeable quantile sketches per language and source.

Each text is measured once: words, their code points, symbols, repeated lines, words inside three-word windows that the
text holds twice. Two base rules are fixed (too few words, mostly repeated words). All others compare a rate with what is
usual among the texts of the same language and source.

The sketch of a rate is the count of documents per bucket, 32 buckets to each power of two: whole numbers only, so that
sketches merge by adding counts, in any order and with the same result after a lost task. Its quartiles give the fences
``q1 - REACH * spread`` and ``q3 + REACH * spread``, ``spread`` being ``q3 - q1`` or the rate's least spread, if that is
more. A group of fewer than ``LEAST`` documents takes the merged sketch of its language, a language of fewer that of all
documents. Every document with a word counts, and none is dropped or sampled.

A task sends one row per bucket it has met, so a source with a third of all rows is a few hundred rows by then. Fences are
joined back onto the measured rows in two parts: groups with a thousandth or more of all documents (at most a thousand
groups, so they are broadcast), and the rest by a shuffle in which no key holds more than a thousandth of the rows.

Null texts count as empty, and texts without a word fail the base rules and enter no sketch. Null languages and sources
are groups of their own. Repeated rows each count and each give a row; an empty table gives no rows. Other columns are not
read. Window hashes have 64 bits, compared within one text only.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rowtide.llm.blocks import SPACES, blocks, mix, ragged, spans, text_of, word_hashes, written

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
LEAST = 200
REACH = 3
HOT = 1000
# Rates per mille: (numerator, denominator, least spread, whether too little counts as well).
RATES = {
    "word_length": ("word_chars", "n_words", 500, True),
    "symbols": ("n_symbols", "n_words", 50, False),
    "repeated_lines": ("n_dup_lines", "n_lines", 100, False),
    "repeated_words": ("n_repeat_words", "n_words", 100, False),
}
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def repeated_words(words: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Per row: words that lie in a three-word window which the row holds at least twice."""
    covered = np.zeros(len(words) + 1, np.int32)
    places = ragged(before[:-1], np.maximum(np.diff(before) - 2, 0))
    if len(places):
        row = np.searchsorted(before, places, "right").astype(np.uint64)
        window = mix(words[places] + mix(words[places + 1] + mix(words[places + 2] + mix(row))))
        _, which, count = np.unique(window, return_inverse=True, return_counts=True)
        again = places[count[which] > 1]
        np.add.at(covered, again, 1)
        np.add.at(covered, again + 3, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    return inside[before[1:]] - inside[before[:-1]]


def _measure(part: pa.Array) -> list[np.ndarray]:
    """The columns ``COUNTS`` of a block of texts."""
    flat, at = text_of(part)
    size = len(at) - 1
    _, _, before = spans(flat, at, SPACES)
    words, _ = word_hashes(flat, at, SPACES, fold=False)

    def per_row(hit: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(hit)])[at]
        return np.diff(total)

    lines, doubles = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for i, text in enumerate(part.to_pylist()):
        held = [x for x in text.split("\n") if x.strip(BLANKS)] if text else ()
        lines[i], doubles[i] = len(held), len(held) - len(set(held))
    letters = SPACES[flat] & ((flat & 0xC0) != 0x80)
    return [np.diff(before), per_row(letters), per_row(SYMBOLS[flat]), lines, doubles, repeated_words(words, before)]


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``doc_id, lang, source``, the counts of each text, and ``base_failed``."""

    def run(batches):
        for batch in batches:
            for part in blocks(batch):
                counts = [pa.array(c.astype(np.int64)) for c in _measure(part.column(3))]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(3)), *counts], names=["doc_id", "lang", "source", *COUNTS])

    kept = [F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")]
    rows = docs.select(*kept).mapInArrow(run, "doc_id long, lang string, source string, " + ", ".join(f"{c} long" for c in COUNTS))
    few, same = F.col("n_words") < MIN_WORDS, 100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    return rows.withColumn("base_failed", few | same)


def rate(name: str) -> Column:
    above, below, _, _ = RATES[name]
    return F.expr(f"if({below} > 0, 1000 * {above} div {below}, 0)")


def bucket_of() -> Column:
    """Bucket of the whole number ``v``: itself below 64, then 32 buckets to each power of two."""
    return F.expr("int(if(v < 64, v, (v >> (length(bin(v)) - 6)) + 32 * (length(bin(v)) - 6)))")


def floor_of(bucket: Column) -> Column:
    """The least number of a bucket."""
    shift = F.floor(bucket / 32).cast("int") - 1
    return F.when(bucket < 64, bucket.cast("long")).otherwise(F.call_function("shiftleft", (bucket - 32 * shift).cast("long"), shift))


def sketches(rows: DataFrame) -> DataFrame:
    """``lang, source, rule, bucket, n``: one mergeable sketch per language, source and rule."""
    each = F.array(*[F.struct(F.lit(r).alias("rule"), rate(r).alias("v")) for r in RATES])
    values = rows.where("n_words > 0").select("lang", "source", F.inline(each))
    return values.groupBy("lang", "source", "rule", bucket_of().alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    return sketch.groupBy(*by, "rule", "bucket").agg(F.sum("n").alias("n"))


def _fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Per group: ``n`` documents and ``fences``, an array of (rule, low, high)."""
    whole = Window.partitionBy(*by, "rule")
    up_to = F.sum("n").over(whole.orderBy("bucket"))
    ranked = sketch.select("*", up_to.alias("seen"), F.sum("n").over(whole).alias("total"))

    def quartile(k: int) -> Column:
        return F.min(F.when(4 * F.col("seen") >= k * F.col("total"), floor_of(F.col("bucket"))))

    least = F.create_map(*[F.lit(x) for r, (_, _, s, _) in RATES.items() for x in (r, s)])
    lower = [r for r, x in RATES.items() if x[3]]
    spread = F.greatest(F.col("q3") - F.col("q1"), least[F.col("rule")])
    low = F.when(F.col("rule").isin(lower), F.col("q1") - REACH * spread).otherwise(F.lit(-1))
    fence = F.struct("rule", low.alias("low"), (F.col("q3") + REACH * spread).alias("high"))
    quartiles = ranked.groupBy(*by, "rule").agg(quartile(1).alias("q1"), quartile(3).alias("q3"), F.max("total").alias("total"))
    return quartiles.groupBy(*by).agg(F.max("total").alias("n"), F.sort_array(F.collect_list(fence)).alias("fences"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """``lang, source, n, fences`` of every language and source, thin groups with the fences of the next wider one."""
    own = _fences(sketch, ["lang", "source"])
    lang = _fences(merged(sketch, ["lang"]), ["lang"]).where(F.col("n") >= LEAST).select(F.col("lang").alias("of"), F.col("fences").alias("wider"))
    widest = _fences(merged(sketch, []), []).first()
    if widest is None or widest["fences"] is None:
        return own
    everything = F.array(*[F.struct(F.lit(f["rule"]).alias("rule"), F.lit(f["low"]).cast("long").alias("low"), F.lit(f["high"]).cast("long").alias("high")) for f in widest["fences"]])
    joined = own.join(lang, F.col("lang").eqNullSafe(F.col("of")), "left")
    return joined.select("lang", "source", "n", F.when(F.col("n") >= LEAST, F.col("fences")).otherwise(F.coalesce("wider", everything)).alias("fences"))


def _failed() -> Column:
    """Names of the rules whose rate lies outside its fence."""
    rates = F.create_map(*[x for r in RATES for x in (F.lit(r), rate(r))])
    none = F.array().cast("array<string>")
    out = F.transform(F.filter("fences", lambda f: (rates[f["rule"]] < f["low"]) | (rates[f["rule"]] > f["high"])), lambda f: f["rule"])
    return F.when(F.col("n_words") > 0, F.coalesce(out, none)).otherwise(none)


def judged(rows: DataFrame, fences: DataFrame) -> DataFrame:
    """Measured rows with ``failed`` (rules beyond their fences) and ``kept``."""
    total = fences.agg(F.sum("n")).first()[0] or 0
    named = fences.select(F.col("lang").alias("of_lang"), F.col("source").alias("of_source"), "n", "fences")
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    often = F.col("n") * HOT >= total
    hot, rest = F.broadcast(named.where(often)), named.where(~often)
    parts = [rows.join(hot, same), rows.join(hot, same, "left_anti").join(rest, same, "left")]
    both = reduce(DataFrame.unionByName, [p.select(*rows.columns, _failed().alias("failed")) for p in parts])
    return both.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))


def quality_rules(docs: DataFrame, **columns: str) -> DataFrame:
    """Per row: the counts, ``base_failed``, the ``failed`` rules and ``kept``."""
    rows = written(measured(docs, **columns), "quality-counts")
    fences = written(thresholds(sketches(rows)), "quality-fences")
    return judged(rows, fences)
