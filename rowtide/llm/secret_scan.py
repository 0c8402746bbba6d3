"""Secrets in whole texts: fixed patterns, and guess-cost dynamic programming over values in a credential's context.

The patterns (kinds assign, access, hex) match leftmost without overlap; too short matches are dropped. Beside them,
each value after a credential word gets the least number of guesses over all its segmentations into dictionary words,
dates, repeats, keyboard walks and brute-force spans. A value that costs at least ``MIN_GUESSES`` (log10) is a span of
kind ``guess`` unless a pattern's span already covers it whole. A value begins behind its credential word, also inside
another value, and ends at a blank, at its closing quote or, without quotes, at a ``&``, ``,`` or ``;`` before a next key.
Offsets are code points, ends exclusive.

The dictionary has two parts: a fixed list, and the words of the scanned texts themselves (``learn_words``): every run of
letters a to z that at least ``LEAST_DOCS`` rows hold and at least one row in ``ONE_IN``, ranked by the rows that hold it.
A share of the rows means the same at every size and bounds the dictionary: it has at most ``ONE_IN`` times as many words
as a row has different words on average. The lower of a word's two ranks counts. A value that the corpus repeats that
often thereby is a known word; the patterns are not touched by it.

A null text is an empty one; a null id stays null; repeated rows are scanned one by one; an empty table gives no rows;
other columns are not read. A value of any length is segmented as a whole, in time about in proportion to its length.
"""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.blocks import blocks

# The patterns of the base kinds, their shortest matches, credential words.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:password|passwd|passphrase|passcode|pwd|pass|pin|secret|token|credentials?|api[_-]?key|access[_-]?key|private[_-]?key|auth|bearer|login)s?["']?(?:\x20*[:=]>?\x20*|\x20is\x20)(["']?)(?=[!-~])""",
    re.I | re.A,
)
# Where a value stops: without quotes, and behind each quote (a quote before a letter or digit belongs to the value).
STOP = re.compile(r"""[^!-~]|[&,;](?=(?:amp;)?[{\[("']*[a-z_][\w.-]*["']?\x20*[:=])|\Z""", re.I | re.A)
CLOSING = {q: re.compile(rf"(?:\\[!-~]|(?!{q}(?![a-z0-9]))[!-~])*+(?={q})", re.I | re.A) for q in "\"'"}
MARKS = ("pass", "pwd", "pin", "secret", "token", "credential", "key", "auth", "bearer", "login")
WALKS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz", "1qaz2wsx3edc4rfv5tgb6yhn7ujm8ik9ol0p")
WORDS = """the of and to a in is it you that he was for on are with as his they be at one have this from or had by hot
but some what there we can out other were all your when up use word how said an each she which do their time if will
way about many then them would write like so these her long make thing see him two has look more day could go come did
my sound no most number who over know water than call first people may down side been now find any new work part take
get place made live where after back little only round man year came show every good me give our under name password
admin login welcome user test pass secret letmein dragon monkey master football baseball shadow sunshine princess love
iloveyou hello freedom whatever trust hunter summer winter spring autumn monday example sample default guest root
server service account token key access api client data base change reset required expired invalid must should not""".split()

MIN_GUESSES = 10.0
LEAST_DOCS = 10
ONE_IN = 10_000
LONGEST = 24
_LEET = str.maketrans("@4301!$57", "aaeoiisst")
_DATE = re.compile(r"(?:19|20)\d\d[-/.]?\d\d[-/.]?\d\d|\d\d?[-/.]\d\d?[-/.](?:19|20)\d\d|(?:19|20)\d\d")
_STEPS = {x for w in WALKS for v in (w, w[::-1]) for x in zip(v, v[1:])}


@dataclass(frozen=True)
class Words:
    """Ranks of known words (from 1, most frequent first) and the length of the longest."""

    rank: dict[str, int]
    longest: int

    @classmethod
    def of(cls, ranked: list[str]) -> Words:
        """The given words in their order, beside the fixed list."""
        rank = {w: i + 1 for i, w in enumerate(dict.fromkeys(WORDS))}
        for i, w in enumerate(ranked):
            rank[w] = min(i + 1, rank.get(w, i + 1))
        return cls(rank, max(map(len, rank)))


FIXED = Words.of([])


def learn_words(docs: DataFrame, text_col: str = "text", least_docs: int = LEAST_DOCS, one_in: int = ONE_IN) -> Words:
    """The words of 3 to ``LONGEST`` letters that enough rows hold, most rows first, ties by name; counted over all rows."""
    texts = docs.select(F.lower(F.col(text_col).cast("string")).alias("text"))
    held = texts.select(F.explode(F.array_distinct(F.split("text", "[^a-z]+"))).alias("word"))
    counted = held.where(F.length("word").between(3, LONGEST)).groupBy("word").agg(F.count("*").alias("n"))
    least = max(least_docs, docs.count() / one_in)
    known = counted.where(F.col("n") >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    return Words.of(known.column("word").to_pylist())


def _alphabet(piece: str) -> int:
    kinds = [(str.isdigit, 10), (str.islower, 26), (str.isupper, 26)]
    size = sum(n for f, n in kinds if any(map(f, piece)))
    return size + 33 * any(not c.isalnum() for c in piece) or 33


def _nearest(starts: list[int], best: list[float], j: int) -> float:
    """Least cost of a run from one of the starts to ``j``; starts that an earlier one undercuts never win again and go."""
    least, kept = math.inf, []
    for i in starts:
        cost = best[i] + math.log10(j - i)
        if cost < least:
            least = cost
            kept.append(i)
    starts[:] = kept
    return least


def guesses(value: str, words: Words = FIXED) -> float:
    """log10 of the guesses that the cheapest segmentation needs."""
    ranks = words.rank
    n, low = len(value), value.lower()
    plain = low.translate(_LEET)
    letter = math.log10(_alphabet(value))
    best = [0.0] + [math.inf] * n
    ends: dict[int, list[tuple[int, float]]] = {}
    for m in _DATE.finditer(value):
        ends.setdefault(m.end(), []).append((m.start(), math.log10(365 * 120) if m.end() - m.start() > 4 else math.log10(120)))
    run = walk = 0
    runs: list[int] = []
    walks: list[int] = []
    for j in range(1, n + 1):
        if j > 1 and low[j - 1] != low[j - 2]:
            run = j - 1
            runs.clear()
        if j > 1 and (low[j - 2], low[j - 1]) not in _STEPS:
            walk = j - 1
            walks.clear()
        best[j] = best[j - 1] + letter
        for i in range(max(0, j - words.longest), j):
            rank = ranks.get(low[i:j]) or ranks.get(plain[i:j])
            if rank and j - i > 1:
                twist = (value[i:j] != low[i:j]) + (plain[i:j] != low[i:j])
                best[j] = min(best[j], best[i] + math.log10(rank + 1) + twist * math.log10(4))
        for i, cost in ends.get(j, ()):
            best[j] = min(best[j], best[i] + cost)
        # a repeat or a walk may begin anywhere inside its run
        if j - 2 >= run:
            runs.append(j - 2)
            best[j] = min(best[j], _nearest(runs, best, j) + letter)
        if j - 3 >= walk:
            walks.append(j - 3)
            best[j] = min(best[j], _nearest(walks, best, j) + math.log10(40))
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place, end) of the patterns' matches."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guess_spans(text: str, base: list[tuple[int, int, int]], least: float = MIN_GUESSES, words: Words = FIXED) -> list[tuple[int, int, int]]:
    """Values in a credential's context that are costly to guess and that no pattern has found."""
    low = text.lower()
    if not any(m in low for m in MARKS):
        return []
    found, stop, judged = [], -1, -1
    for m in CONTEXT.finditer(text):
        start = m.end()
        closing = CLOSING[m[1]].match(text, start) if m[1] else None
        if not closing and start >= stop:
            stop = STOP.search(text, start).start()
        value = text[start : closing.end() if closing else stop].rstrip("\"'`,;.!?)]}")
        end = start + len(value)
        # The rest of a judged value costs no more than the whole did, and is inside its span if there is one.
        if len(value) < 6 or end == judged or any(s <= start and end <= e for s, _, e in base):
            continue
        judged = end
        if guesses(value, words) >= least:
            found.append((start, 3, end))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(text: str, least: float = MIN_GUESSES, words: Words = FIXED) -> tuple[list, list]:
    """The patterns' spans, and these with the values found by guess cost, both by start and kind."""
    base = base_spans(text)
    return base, sorted(base + guess_spans(text, base, least, words))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = MIN_GUESSES, words: Words = FIXED) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans`` of each row."""
    known = docs.sparkSession.sparkContext.broadcast(words)
    schema = "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string"

    def find(batches):
        for batch in batches:
            for part in blocks(batch):
                found = [scan(t or "", least, known.value) for t in part.column(1).to_pylist()]
                n = np.array([[sum(k == kind for _, k, _ in every) for kind in range(4)] for _, every in found], np.int64).reshape(-1, 4)
                digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *(pa.array(n[:, k]) for k in range(4)), pa.array(digests, pa.string()), pa.array([joined(every) for _, every in found], pa.string())],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "n_guess", "base_sha256", "spans"],
                )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(find, schema)


def mask_secrets(docs: DataFrame, text_col: str = "text", least: float = MIN_GUESSES, words: Words = FIXED) -> DataFrame:
    """The same rows and columns with each found span overwritten by ``[SECRET]`` (overlapping spans by one)."""
    known = docs.sparkSession.sparkContext.broadcast(words)

    def mask(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for start, _, end in scan(text, least, known.value)[1]:
            if start >= at:
                out += [text[at:start], "[SECRET]"]
            at = max(at, end)
        return "".join(out) + text[at:] if out else text

    place = docs.columns.index(text_col)

    def change(batches):
        for batch in batches:
            for part in blocks(batch, text_col):
                texts = [mask(t) for t in part.column(place).to_pylist()]
                yield part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))

    return docs.mapInArrow(change, docs.schema)
