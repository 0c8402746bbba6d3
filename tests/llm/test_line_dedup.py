import random

import xxhash

from rowtide.llm.line_dedup import LEAST, remove_repeats, units
from tests.llm.data import docs_of, odd_texts, rows, same_rows, table, words


def brute(texts, least=LEAST):
    """Rows by id (none last) and hash of the text, one after the other: what has been seen is remembered in two sets."""
    seen, pairs, out = set(), set(), []

    def rank(row):
        i, t = row
        key = 0 if t is None else xxhash.xxh64(t.encode(), seed=42).intdigest()
        return i is None, i or 0, key - (1 << 64) if key >> 63 else key

    for i, t in sorted(texts, key=rank):
        found, runs, last = units(t or ""), [], None
        for k, (a, b, d) in enumerate(found):
            if d in seen:
                if last == k - 1 and (found[k - 1][2], d) in pairs:
                    runs[-1].append((a, b))
                else:
                    runs.append([(a, b)])
                last = k
            if k:
                pairs.add((found[k - 1][2], d))
            seen.add(d)
        gone = [s for run in runs if sum(len(t[a:b].encode()) for a, b in run) >= least for s in run]
        left = None if t is None else "".join(c for k, c in enumerate(t) if not any(a <= k < b for a, b in gone))
        out.append((i, len(found), gone, left))
    return out


def got_of(frame):
    return [(r.doc_id, r.n_units, [(s.start, s.end) for s in r.removed], r.text) for r in frame.collect()]


def test_units():
    text = "One two three four five six. Seven eight nine ten eleven 1.5 times!\n  A line of its own with words  \nshort one."
    assert [text[a:b] for a, b, _ in units(text)] == ["One two three four five six.", "Seven eight nine ten eleven 1.5 times!", "A line of its own with words", "short one."]
    assert units("The same unit  here\tof words")[0][2] == units("the SAME unit here of words ")[0][2]


def test_given_documents(spark):
    docs = table(spark, "documents")
    texts = rows(docs.select("doc_id", "text"))
    for least in (LEAST, 40, 1):
        want = brute(texts, least)
        assert sum(len(r[2]) for r in want) > 50 and same_rows(got_of(remove_repeats(docs, least)), want)


def test_a_passage_inside_lines_is_found(spark):
    rng = random.Random(1)
    passage = " ".join(" ".join(words(12, k, 10**6)).capitalize() + "." for k in range(6))
    own = lambda i: " ".join(words(20, 100 + i, 10**6)) + "."
    texts = [(i, f"{own(i)} {passage} {own(1000 + i)}") for i in range(30)]
    rng.shuffle(texts)
    got = {r[0]: r for r in got_of(remove_repeats(docs_of(spark, texts)))}
    assert got[0][2] == [] and all(len(got[i][2]) == 6 and passage[:40] not in got[i][3] for i in range(1, 30))
    assert all(own(i) in got[i][3] and own(1000 + i) in got[i][3] for i in range(30))


def test_chance_repeats_stay(spark):
    rng = random.Random(2)
    texts = [(i, "\n".join(rng.choice(["To.", "Yes.", "In the end.", "Th.", " ".join(words(9, 50 * i + k, 10**6)) + "."]) for k in range(30))) for i in range(40)]
    got = got_of(remove_repeats(docs_of(spark, texts)))
    assert same_rows(got, brute(texts)) and all(r[2] == [] for r in got)


def test_passages_of_short_sentences_and_of_scripts_without_blanks(spark):
    short = " ".join(f"Say it {n}." for n in "one two three four five six seven eight nine ten eleven twelve thirteen fourteen".split())
    lines = "\n".join("這是一行沒有空格的文字而且在每個文件裡都出現" + c for c in "甲乙丙")
    thai = "ข้อความนี้ไม่มีช่องว่างและปรากฏในทุกเอกสารของชุดนี้เสมอ"
    for passage, n in ((short, 14), (lines, 3), (thai, 1)):
        texts = [(i, f"Own {i} stands here.\n{passage}\nEnd {i}.") for i in range(4)]
        got = {r[0]: r for r in got_of(remove_repeats(docs_of(spark, texts)))}
        assert got[0][2] == [] and all(len(got[i][2]) == n and got[i][3].startswith(f"Own {i}") and got[i][3].endswith(f"End {i}.") for i in (1, 2, 3))


def test_a_shuffled_passage_hangs_together_only_where_it_has_stood_so(spark):
    a, b, c = (f"Sentence {x} of some forty five bytes or more in all{x}." for x in "abc")
    texts = [(1, f"{a} {b} {c}"), (2, f"{c} {b} {a}"), (3, f"{a} {b} {c}"), (4, f"x {b}\n{b} {c}")]
    got = {r[0]: r for r in got_of(remove_repeats(docs_of(spark, texts)))}
    assert same_rows(list(got.values()), brute(texts))
    assert got[2][2] == [] and len(got[3][2]) == 3 and got[4][2] == []


def test_rows_that_share_an_id_or_have_none(spark):
    line = " ".join(words(40, 8)) + "."
    texts = [(5, line), (5, line), (None, line + " tail one"), (None, line), (None, line), (5, line + "\nmore"), (None, None), (None, None), (3, ""), (3, "")]
    got = got_of(remove_repeats(docs_of(spark, texts)))
    assert same_rows(got, brute(texts)) and sum(r[2] == [] and bool(r[3]) for r in got) == 1


def test_odd_texts(spark):
    assert same_rows(got_of(remove_repeats(docs_of(spark, odd_texts()))), brute(odd_texts()))


def test_repeats_inside_one_text_and_empty(spark):
    line = "this line stands here three times over " * 4
    got = got_of(remove_repeats(docs_of(spark, [(1, f"{line}\n{line}\nend\n{line}")])))
    n = len(line.rstrip())
    at = [len(line) + 1, 2 * len(line) + 6]
    assert got[0][:3] == (1, 4, [(a, a + n) for a in at])
    assert rows(remove_repeats(docs_of(spark, []))) == []
