"""Small tables with the odd cases: nulls, empty and very long texts, repeated rows, clashing column names."""

import random
import tracemalloc

from pyspark.sql import types as T

from rowtide.frames import small_frame

SF = "/root/testdata/sf0.001"
CLASHES = ["id", "node", "bin", "term", "own", "own_id", "component", "kept", "value", "n", "kept_id", "copy_number", "bad_key", "row_key", "held_text", "least_row", "text_sha256", "signature"]
SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in CLASHES]
)


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def docs_of(spark, texts, lang="en"):
    """A table of documents from (doc_id, text) pairs, with columns whose names operators use inside."""
    rows = [(i, t, lang, None, None if t is None else len(t), *(["x"] * len(CLASHES))) for i, t in texts]
    return small_frame(spark, rows, SCHEMA)


def odd_texts():
    long = " ".join(words(20_000, 1, 5000))
    same = " ".join(words(60, 2))
    return [
        (None, "no id, but words enough to be found by whatever looks for them here"),
        (None, None),
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, "one"),
        (5, long),
        (6, "x" * 50_000),
        (7, same),
        (8, same),
        (8, same),
        (9, same + " tail"),
        (10, "... !!! 123"),
        (11, "日本語 の テキスト 😀 ﬁ İstanbul ▁mark"),
    ]


def table(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def same_rows(got, want):
    def key(r):
        return tuple((x is None, "" if x is None else str(x)) for x in r)

    return sorted(got, key=key) == sorted(want, key=key)


class Task:
    """In place of a table: what an operator would run in its tasks."""

    def mapInArrow(self, run, schema):
        return run


def peak_mb(work):
    """MB that Python and NumPy hold at once while ``work`` runs, beyond what they held before."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()
