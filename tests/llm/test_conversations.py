import binascii
import hashlib
import heapq
import random

import pytest
from pyspark.sql import types as T

from rowtide.frames import small_frame
from rowtide.llm.conversations import WINDOW, cheapest, damaged, repair, repaired
from tests.llm.data import rows, same_rows, table

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())] + [T.StructField(c, T.StringType()) for c in ("conv", "of", "place", "times", "end", "n", "first")])
BLANKS = " \t\n\x0b\x0c\r"


def frame(spark, data):
    return small_frame(spark, [(*r, *["x"] * 7) for r in data], SCHEMA)


def plain_cheapest(codes):
    """Least (cost, letters) by best-first search over whole strings."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, letters, i, roles = heapq.heappop(heap)
        tail = "0" if not roles else roles[-1]
        if (i, tail) in done:
            continue
        done.add((i, tail))
        if i == len(codes) and tail in "0a":
            return cost, letters
        wanted = "a" if tail == "u" else "u"
        heapq.heappush(heap, (cost + 3, letters + "I", i, roles + wanted))
        if i < len(codes):
            c = codes[i]
            heapq.heappush(heap, (cost + 4, letters + "D", i + 1, roles))
            if c != "-":
                cut = 3 if c.isupper() else 0
                heapq.heappush(heap, (cost + 3 + cut, letters + "R", i + 1, roles + wanted))
                if c.lower() == wanted or c.lower() == "s" and tail == "0":
                    heapq.heappush(heap, (cost + cut, letters + "K", i + 1, roles + c.lower()))


def plain_repair(data):
    """Every step over Python lists, as the contract words it."""
    out, turns_out = [], []
    for conv in {r[0] for r in data}:
        mine = sorted((r for r in data if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " "))
        mine = [(r[1], " " if r[2] is None else r[2], " " if r[3] is None else r[3]) for r in mine]
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        blank = duplicate = truncated = 0
        codes, seen = "", set()
        for turn, role, text in mine:
            end = text.rstrip(BLANKS)[-1:]
            if not end:
                blank += 1
                codes += "-"
            elif (role, text) in seen:
                duplicate += 1
                codes += "-"
            else:
                c = role[:1] if role[:1] in ("s", "u", "a") else "x"
                truncated += end not in ".!?"
                codes += c.upper() if end not in ".!?" else c
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        numbers = [t for t, _, _ in mine if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, letters = plain_cheapest(codes)
        left, stay = iter(mine), []
        for x in letters:
            wanted = "assistant" if stay and stay[-1][1][:1] == "u" else "user"
            if x == "I":
                stay.append((x, wanted, ""))
                continue
            _, role, text = next(left)
            if x != "D":
                stay.append((x, wanted if x == "R" else role, text))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for _, r, t in stay).encode()).hexdigest()
        out.append((conv, gaps, blank, duplicate, truncated, illegal, cost, letters, digest))
        turns_out += [(conv, k, *x) for k, x in enumerate(stay)]
    return out, turns_out


def some_rows(seed, conversations=30):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Well?", "", " \n", "Go on!", None, "a b c.", "…", "x.\n", "ende "]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "u", "USER"]
    out = []
    for c in [None, *range(conversations)]:
        for t in range(rng.randrange(0, 14)):
            out += [(c, rng.choice([t, t, t, None, 3 * t]), rng.choice(roles), rng.choice(texts))] * rng.choice([1, 1, 1, 3])
    return out


def test_auction_is_best_first_search():
    rng = random.Random(5)
    for n in [0, 1, 2, 3, 5, 9, WINDOW, WINDOW + 1, 3 * WINDOW + 5]:
        for _ in range(60):
            codes = "".join(rng.choice("uauauauasxUA-SX") for _ in range(n))
            assert cheapest(codes) == plain_cheapest(codes), codes


@pytest.mark.parametrize("large", [(1 << 16, 1 << 26), (4, 1 << 26), (1 << 16, 12), (0, 0)])
def test_odd_rows_in_both_ways(spark, large):
    data = some_rows(11)
    want, turns = plain_repair(data)
    limits = dict(zip(("large_rows", "large_bytes"), large))
    assert same_rows(rows(repair(frame(spark, data), **limits)), want)
    assert same_rows(rows(repaired(frame(spark, data), **limits)), turns)


def test_many_equal_rows_and_a_long_conversation(spark):
    rng = random.Random(3)
    data = [(1, 0, "user", "Yes.")] * 300 + [(2, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Go.", "On", f"T{t}."])) for t in range(700)]
    want, _ = plain_repair(data)
    assert same_rows(rows(repair(frame(spark, data))), want)
    assert same_rows(rows(repair(frame(spark, data), large_rows=100)), want)


def test_damage(spark):
    data = [(c, t, "assistant", "One. Two! Three? Four") for c in [None, *range(40)] for t in [None, *range(6)]] + [(50, 1, None, None)]
    want = []
    for c, t, role, text in data:
        kind = binascii.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = [tuple(r)[:4] for r in damaged(frame(spark, data)).collect() for _ in range(r.times)]
    assert same_rows(got, want)


def test_conversations_without_rows_and_empty_tables(spark):
    data = [(7, 1, "user", "Yes.")]
    out = rows(repair(frame(spark, data).selectExpr("conv_id", "turn", "role", "text", "0 as gone"), times_col="gone"))
    assert out == [(7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert rows(repair(frame(spark, []))) == [] and rows(repaired(frame(spark, []))) == []


def test_large_way_on_the_given_table(spark):
    hurt = damaged(table(spark, "conversations"))
    assert same_rows(rows(repair(hurt, times_col="times", large_rows=3)), rows(repair(hurt, times_col="times")))
