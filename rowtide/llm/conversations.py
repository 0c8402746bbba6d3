"""Repair of conversation structure: the cheapest edits that leave turns of the form ``(s?(ua)+)?`` by role initials.

Edits: Keep 0, Rerole to user or assistant 3, Delete 4, Insert of an empty user or assistant turn 3; a truncated row that
stays adds 3, blank and duplicate rows must be deleted. Of equally cheap edits those with the ASCII-least letters count.

The edits of a conversation are paths of a lattice whose nodes are (rows used, state), the state being what the roles so
far allow next. Cheapest paths are found by the auction algorithm: node prices start at 0, a path grows from its origin
along the arc with the least cost plus price, and where a node's price lies below that sum the price is raised to it and
the path drops the node again. A path that meets a node of known distance ends, and all its nodes are known. Origins are
the four nodes in front of every ``WINDOW`` rows, from the last on, so work and prices stay linear in the rows; of prices
only those in front of windows are held. Converged prices show the arcs that lie on cheapest paths: from the first node on
the least letter among them is followed, the auction being run again from each node that is looked at.

Rows are taken by turn (nulls first), then role and text. Conversations are dealt by id and each is read as a sorted
stream. One of over ``LARGE_ROWS`` rows or ``LARGE_BYTES`` of text goes another, exact way: equal rows become one with a
count, before and after the shuffle, first occurrences come from a grouping by (conversation, digest), and one stream
without texts gives the edits, a byte per row (the result itself has as many), a second the hash, which is sequential by
definition; it holds one row at a time.

Null roles and texts count as one blank. Null turns are earliest and no gap; all rows with a null conversation are one.
Conversations without rows (``times`` 0) give zeros and empty edits; an empty table gives no rows. Repeated rows are rows
of their own and hence duplicates. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from rowtide.llm.blocks import written

LARGE_ROWS = 1 << 16
LARGE_BYTES = 64 << 20
WINDOW = 32
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"

# States: nothing yet, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
# What a user or assistant turn makes of each state, and whose turn it is.
NEXT = (USER, USER, ASSISTANT, USER)
SPEAKER = ("user", "user", "assistant", "user")
TURN = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("a", USER): ASSISTANT, ("u", ASSISTANT): USER}


def _row_arcs(code: str, state: int) -> tuple[tuple[str, int, int, int], ...]:
    """(letter, cost, rows used, next state) out of a node, in the order of the letters.

    ``code`` is the row's role initial, upper case if it is truncated, or ``-`` if it must go; ``""`` is the end.
    """
    arcs = [("I", INSERT, 0, NEXT[state])]
    if code:
        arcs.append(("D", DELETE, 1, state))
    if code not in ("", "-"):
        cut = CUT if code.isupper() else 0
        arcs.append(("R", REROLE + cut, 1, NEXT[state]))
        if (code.lower(), state) in TURN:
            arcs.append(("K", KEEP + cut, 1, TURN[code.lower(), state]))
    elif not code and state in (START, ASSISTANT):
        arcs.append(("", 0, 1, START))
    return tuple(sorted(arcs))


ARCS = {c: tuple(_row_arcs(c, s) for s in range(4)) for c in ["", "-", *"suaxSUAX"]}


class Window:
    """Some rows of the lattice, with exact prices behind them; node 4 * row + state."""

    def __init__(self, codes: str, behind: list[int] | None):
        self.end = 4 * len(codes)
        rows = list(codes)
        if behind is None:
            # the last rows: one more column for what is inserted behind them, then the destination
            rows.append("")
            self.end += 4
            behind = [0] * 4
        self.price = [0] * self.end + behind
        self.known = bytearray(self.end) + b"\1" * 4
        self.arcs = [[(letter, cost, 4 * (i + used) + to) for letter, cost, used, to in ARCS[c][s]] for i, c in enumerate(rows) for s in range(4)]

    def settle(self, origin: int) -> int:
        """Path contraction and extension from a node until its price is its distance."""
        price, known, arcs = self.price, self.known, self.arcs
        path = [origin]
        node = origin
        while not known[node]:
            best, to = 1 << 62, -1
            for _, cost, target in arcs[node]:
                if cost + price[target] < best:
                    best, to = cost + price[target], target
            if price[node] < best:
                price[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
            node = path[-1]
        for node in path:
            known[node] = 1
        return price[origin]

    def trace(self, node: int) -> tuple[str, int]:
        """The least letters along tight arcs up to the rows behind, and the state there."""
        letters = []
        self.settle(node)
        while node < self.end:
            for letter, cost, target in self.arcs[node]:
                if cost + self.price[target] == self.price[node] and cost + self.settle(target) == self.price[node]:
                    letters.append(letter)
                    node = target
                    break
        return "".join(letters), node - self.end


def cheapest(codes: str) -> tuple[int, str]:
    """Cost and letters of the edits."""
    starts = range(0, max(1, len(codes)), WINDOW)
    behind: list[list[int] | None] = [None]
    for a in reversed(starts[1:]):
        window = Window(codes[a : a + WINDOW], behind[-1])
        behind.append([window.settle(s) for s in range(4)])
    letters, state, cost = [], START, 0
    for a, prices in zip(starts, reversed(behind)):
        window = Window(codes[a : a + WINDOW], prices)
        if a == 0:
            cost = window.settle(START)
        part, state = window.trace(state)
        letters.append(part)
    return cost, "".join(letters)


@functools.lru_cache(1 << 15)
def _cheapest_short(codes: str) -> tuple[int, str]:
    return cheapest(codes)


class Edits:
    """Edits applied to rows as they come: (letter, role, text) of the turns that stay."""

    def __init__(self, letters: str):
        self.letters, self.at, self.state = letters, 0, START

    def use(self, role: str, text: str, times: int = 1):
        """``times`` equal rows, and what is inserted before each of them."""
        while times:
            letter = self.letters[self.at]
            if letter == "I":
                yield self._insert()
                continue
            self.at += 1
            times -= 1
            if letter == "K":
                self.state = TURN[role[:1], self.state]
                yield letter, role, text
            elif letter == "R":
                role_now, self.state = SPEAKER[self.state], NEXT[self.state]
                yield letter, role_now, text

    def rest(self):
        while self.at < len(self.letters):
            yield self._insert()

    def _insert(self):
        self.at += 1
        role, self.state = SPEAKER[self.state], NEXT[self.state]
        return "I", role, ""


class Conversation:
    """Counts and codes of one conversation, from its rows in order."""

    def __init__(self):
        self.codes, self.turns, self.low, self.high, self.last = [], 0, None, None, None
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial = None

    def add(self, turn: int | None, role: str, end: str, first: bool, times: int = 1) -> None:
        """``times`` equal rows; ``end`` is the last character that is no blank."""
        if turn is not None and turn != self.last:
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
            self.turns += 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        self.illegal += times - 1
        gone = times
        if not end:
            self.blank += times
        else:
            cut = end not in ENDS
            gone -= first
            self.duplicate += gone
            self.truncated += first and cut
            if first:
                code = initial if initial in ("s", "u", "a") else "x"
                self.codes.append(code.upper() if cut else code)
        self.codes.append("-" * gone)

    def result(self) -> tuple:
        codes = "".join(self.codes)
        cost, letters = _cheapest_short(codes) if len(codes) <= 2 * WINDOW else cheapest(codes)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, letters


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SUMMARY = ", ".join(f"{c} long" for c in COUNTS) + ", audit string"
_OUT = 1 << 14


def _runs(batches):
    """(conversation, rows or None at its end) of sorted batches; rows without the conversation."""
    now, some = None, False
    for batch in batches:
        for conv, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if some and conv != now:
                yield now, None
            now, some = conv, True
            yield now, row
    if some:
        yield now, None


class _Out:
    """Rows gathered into record batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: tuple, size: int = 0):
        self.rows.append(row)
        self.bytes += size + 64
        return self.full()

    def full(self, force: bool = False):
        if self.rows and (force or len(self.rows) >= _OUT or self.bytes >= 4 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema)
            self.rows, self.bytes = [], 0


def _prepared(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, times_col: str | None) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    times = F.col(times_col).cast("long") if times_col else F.lit(1).cast("long")
    out = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text"), times.alias("times"))
    return out.withColumn("end", F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1))


def _sorted(rows: DataFrame, *order: Column) -> DataFrame:
    return rows.repartition("conv").sortWithinPartitions(F.asc_nulls_first("conv"), *order)


_IN_ORDER = (F.asc_nulls_first, "turn"), (F.asc, "role"), (F.asc, "text")


def _order() -> list[Column]:
    return [way(c) for way, c in _IN_ORDER]


def _schema(kind: T.DataType, fields: str) -> tuple[str, pa.Schema]:
    types = {"long": pa.int64(), "string": pa.string(), "int": pa.int32()}
    parts = [f.split() for f in fields.split(", ")]
    return f"conv {kind.simpleString()}, {fields}", pa.schema([("conv", to_arrow_type(kind))] + [(n, types[t]) for n, t in parts])


def _whole(rows: DataFrame, texts: bool) -> DataFrame:
    """Each conversation at once: its summary and hash, or its repaired turns."""
    ddl, schema = _schema(rows.schema["conv"].dataType, "place long, edit string, role string, text string" if texts else f"{_SUMMARY}, repaired_sha256 string")

    def run(batches):
        out, held, seen, state = _Out(schema), [], set(), Conversation()
        for conv, row in _runs(batches):
            if row is not None:
                turn, role, text, times, end = row
                if times:
                    state.add(turn, role, end, (role, text) not in seen, times)
                    seen.add((role, text))
                    held.append((role, text, times))
                continue
            *counts, letters = state.result()
            edits = Edits(letters)
            stay = [turn for role, text, times in held for turn in edits.use(role, text, times)]
            stay += edits.rest()
            if texts:
                for place, (letter, role, text) in enumerate(stay):
                    yield from out.add((conv, place, letter, role, text), len(text))
            else:
                digest = hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text in stay).encode()).hexdigest()
                yield from out.add((conv, *counts, letters, digest), len(letters))
            held, seen, state = [], set(), Conversation()
        yield from out.full(True)

    return _sorted(rows, *_order()).mapInArrow(run, ddl)


def _edits(rows: DataFrame) -> DataFrame:
    """Summaries of large conversations, from rows without texts."""
    ddl, schema = _schema(rows.schema["conv"].dataType, _SUMMARY)

    def run(batches):
        out, state = _Out(schema), Conversation()
        for conv, row in _runs(batches):
            if row is not None:
                turn, role, end, first, times = row
                if times:
                    state.add(turn, role, end, first, times)
                continue
            yield from out.add((conv, *state.result()), len(state.codes))
            state = Conversation()
        yield from out.full(True)

    return _sorted(rows, F.asc("place")).drop("place").mapInArrow(run, ddl)


def _applied(rows: DataFrame, edits: DataFrame, texts: bool) -> DataFrame:
    """Large conversations again, with their texts: the edits stand in front of the rows."""
    ddl, schema = _schema(rows.schema["conv"].dataType, "place long, edit string, role string, text string" if texts else "repaired_sha256 string")
    marked = edits.select("conv", F.lit(-1).cast("long").alias("place"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(1).cast("long").alias("times"))
    both = rows.select("conv", "place", "role", "text", "times").unionByName(marked)

    def run(batches):
        out, edits, digest, count = _Out(schema), None, None, 0
        for conv, row in _runs(batches):
            if row is None:
                turns = edits.rest()
            elif row[0] < 0:
                edits, digest, count = Edits(row[2]), hashlib.sha256(), 0
                continue
            else:
                turns = edits.use(*row[1:])
            for letter, role, text in turns:
                if texts:
                    yield from out.add((conv, count, letter, role, text), len(text))
                else:
                    digest.update((f"\n{role}:{text}" if count else f"{role}:{text}").encode())
                count += 1
            if row is None and not texts:
                yield from out.add((conv, digest.hexdigest()))
        yield from out.full(True)

    return _sorted(both, F.asc("place")).mapInArrow(run, ddl)


def _large(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct rows of large conversations with their place and count, and the edits of each conversation."""
    once = rows.where("times > 0").groupBy("conv", "turn", "role", "text", "end").agg(F.sum("times").alias("times"))
    once = once.withColumn("digest", F.md5(F.concat_ws(":", F.char_length("role"), "role", "text")))
    early = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    firsts = once.groupBy(F.col("conv").alias("of"), F.col("digest").alias("same")).agg(F.min(early)["turn"].alias("from"))
    here = F.col("conv").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("same")) & F.col("turn").eqNullSafe(F.col("from"))
    known = once.join(firsts, here, "left").withColumn("first", F.col("same").isNotNull()).drop("of", "same", "from", "digest")
    order = [F.asc_nulls_first("conv"), *_order()]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = known.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    placed = written(in_order.withColumn("place", F.monotonically_increasing_id()), "large-conversations")
    return placed, written(_edits(placed.select("conv", "place", "turn", "role", "end", "first", "times")), "large-edits")


def _split(rows: DataFrame, large_rows: int, large_bytes: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of conversations that one task holds whole, and of larger ones, if there are any."""
    sizes = rows.groupBy(F.col("conv").alias("of")).agg(F.sum("times").alias("n"), F.sum(F.octet_length("text") * F.col("times")).alias("bytes"))
    large = written(sizes.where((F.col("n") > large_rows) | (F.col("bytes") > large_bytes)).select("of", F.lit(True).alias("large")), "large")
    if large.isEmpty():
        return rows, None
    same = F.col("conv").eqNullSafe(F.col("of"))
    return rows.join(large, same, "left_anti"), rows.join(large, same, "left_semi")


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", times_col: str | None = None, large_rows: int = LARGE_ROWS, large_bytes: int = LARGE_BYTES) -> DataFrame:
    """Per conversation: the counts, ``cost``, ``audit`` (the edits' letters) and ``repaired_sha256`` of its turns.

    ``times_col`` counts how often a row stands there; 0 keeps the conversation in the result without the row.
    """
    small, big = _split(_prepared(rows, conv_col, turn_col, role_col, text_col, times_col), large_rows, large_bytes)
    out = _whole(small, texts=False)
    if big is not None:
        placed, edits = _large(big)
        hashes = _applied(placed, edits, texts=False).withColumnRenamed("conv", "of")
        out = out.unionByName(edits.join(hashes, F.col("conv").eqNullSafe(F.col("of"))).drop("of"))
    return out.withColumnRenamed("conv", conv_col)


def repaired(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", times_col: str | None = None, large_rows: int = LARGE_ROWS, large_bytes: int = LARGE_BYTES) -> DataFrame:
    """The turns of the repaired conversations: ``place`` from 0, ``edit`` (K, R or I), ``role``, ``text``."""
    small, big = _split(_prepared(rows, conv_col, turn_col, role_col, text_col, times_col), large_rows, large_bytes)
    out = _whole(small, texts=True)
    if big is not None:
        out = out.unionByName(_applied(*_large(big), texts=True))
    return out.withColumnRenamed("conv", conv_col)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, times``: rows damaged by a hash of conversation and turn; nulls are one blank."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, ENDS, "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )
