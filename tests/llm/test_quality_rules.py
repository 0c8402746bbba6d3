import random
import re

from pyspark.sql import functions as F

from rowtide.llm import quality_rules as qr
from tests.llm.data import docs_of, odd_texts, rows, same_rows, table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    again = {p for i, g in enumerate(windows) if windows.count(g) > 1 for p in (i, i + 1, i + 2)} if len(w) < 5000 else set()
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), sum(x in lines[:i] for i, x in enumerate(lines)), len(again)


def plain_rates(c):
    return {"word_length": 1000 * c[1] // c[0], "symbols": 1000 * c[2] // c[0], "repeated_lines": 1000 * c[4] // c[3], "repeated_words": 1000 * c[5] // c[0]}


def plain_verdicts(docs):
    """Thresholds from sorted lists of floored rates, group by group."""
    counts = [(d, l, s, plain_counts(t)) for d, t, l, s in docs]

    def quartiles(group, rule):
        v = sorted(x if x < 64 else x >> (x.bit_length() - 6) << (x.bit_length() - 6) for x in (plain_rates(c)[rule] for _, l, s, c in counts if c[0] and group(l, s)))
        return v[-(-len(v) // 4) - 1], v[-(-3 * len(v) // 4) - 1]

    out = []
    for d, l, s, c in counts:
        failed = []
        if c[0]:
            groups = [lambda a, b: (a, b) == (l, s), lambda a, b: a == l, lambda a, b: True]
            group = next(g for k, g in enumerate(groups) if k == 2 or sum(1 for x in counts if x[3][0] and g(x[1], x[2])) >= qr.LEAST)
            for rule, value in plain_rates(c).items():
                q1, q3 = quartiles(group, rule)
                spread = max(q3 - q1, qr.RATES[rule][2])
                if value > q3 + qr.REACH * spread or rule == "word_length" and value < q1 - qr.REACH * spread:
                    failed.append(rule)
        base = c[0] < 50 or 100 * c[5] > 50 * c[0]
        out.append((d, *c, base, ",".join(sorted(failed)), not base and not failed))
    return out


def judged(docs):
    found = qr.quality_rules(docs)
    return rows(found.select("doc_id", *qr.COUNTS, "base_failed", F.array_join(F.sort_array("failed"), ","), "kept"))


def varied(seed, n):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = ["".join(rng.choices("abcdefgh", k=rng.randrange(2, 9))) for _ in range(rng.choice([0, 4, 60, 80, 120]))]
        if i % 17 == 0:
            words = [w + "$$$$" for w in words]
        if i % 19 == 0:
            words = words[:20] * 4
        if i % 23 == 0:
            words = [w * 5 for w in words]
        text = "".join(w + rng.choice(" \t \n") for w in words)
        if i % 29 == 0:
            text += "same line here\n" * 9
        out.append((i // 2, text if i % 31 else None, rng.choice(["en", "en", "en", "de", None]), rng.choice(["a", "a", "a", "b", None, f"s{i}"])))
    return out


def test_verdicts_are_those_of_sorted_lists(spark):
    docs = varied(4, 700)
    frame = docs_of(spark, [(i, t) for i, (_, t, _, _) in enumerate(docs)])
    named = spark.createDataFrame([(i, d, l, s) for i, (d, _, l, s) in enumerate(docs)], "doc_id long, d long, l string, s string")
    frame = frame.join(named, "doc_id").withColumns({"doc_id": F.col("d"), "lang": F.col("l"), "source": F.col("s")}).drop("d", "l", "s")
    frame = frame.withColumns({"of_lang": F.lit(1), "fences": F.lit(2), "failed": F.lit(3)})
    got, want = judged(frame), plain_verdicts(docs)
    assert same_rows(got, want)
    assert {x for _, *_, f, _ in want for x in f.split(",")} >= set(qr.RATES)


def test_hot_and_rare_groups_join_alike(spark, monkeypatch):
    docs = table(spark, "documents")
    whole = judged(docs)
    monkeypatch.setattr(qr, "HOT", 3)
    assert same_rows(judged(docs), whole)


def test_sketches_merge_in_any_order(spark):
    rows_ = qr.measured(table(spark, "documents"))
    whole = qr.merged(qr.sketches(rows_), ["lang"])
    halves = [qr.sketches(rows_.where(F.col("doc_id") % 2 == k)) for k in (1, 0)]
    assert same_rows(rows(qr.merged(halves[0].unionByName(halves[1]), ["lang"])), rows(whole))


def test_odd_texts(spark):
    got = {r[:-3] for r in judged(docs_of(spark, odd_texts()))}
    want = {(i, *plain_counts(t)) for i, t in odd_texts()}
    assert {x for x in got if x[0] != 5} == {x for x in want if x[0] != 5}
    assert [r[1:4] for r in got if r[0] == 5] == [r[1:4] for r in want if r[0] == 5]
    assert judged(docs_of(spark, [])) == []
