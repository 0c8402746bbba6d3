"""Merge-type pieces with seeded merge dropout, and their lossless decoding.

The agenda of a unit of text holds its neighbouring symbols that the vocabulary joins; the best ranked, leftmost one is
merged, and new neighbours enter. A candidate is skipped for good when a hash keyed by (seed, document's id, unit's number
there, place, merge) falls under the dropout rate, so the same key always gives the same segmentation, and each occurrence
of a unit has draws of its own; with dropout 0 the pieces are the library's own.

No merge crosses the place between a character and a following word mark, nor any side of a line feed, so texts are
worked on as units (marks with the word behind them). Occurrences of a unit share their agenda as long as their draws do:
each distinct unit of a block is segmented once without dropout, and an occurrence that skips none of the candidates met
there has just these pieces. The others are grouped by what they skip there; one of each group is run with its own draws,
and whoever draws alike for every candidate which that run has met has its pieces. The rest is grouped again.
All units of a length class take one agenda step at a time in NumPy; units above ``LONG`` characters have an agenda of
their own.

Characters without a piece become byte pieces; so does a literal word mark in the text, where the library would give
back a blank. Null and empty texts have no pieces and decode to the empty text. A null id counts as id 0 for the key
and stays null. Repeated rows give equal pieces; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.blocks import blocks, mix, ragged, text_of

DROPOUT = 0.1
SEED = 17
DRAWS = 1 << 18
HASHED = 1 << 17  # characters whose prefix sums are held at once
CELLS = 1 << 18  # symbols, with the empty places behind shorter units, that take agenda steps together
BLOCK = 1 << 19  # bytes of text worked on at once: more of them share more units, and hold more arrays
LONG = 64
ALONE = 0.7  # with more groups of equal draws than this share of the units, each unit is run for itself
MARK = 0x2581
FEED = 0x0A
NONE = np.int32(1 << 30)
_BASE = np.uint64(0xD1342543DE82EF95)


class Vocabulary:
    """Merges of a vocabulary file as arrays; symbols above the pieces are characters that only occur inside pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(self.size)]
        plain = [i for i in range(self.size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        self.byte = {int(names[i][3:5], 16): i for i in range(self.size) if model.is_byte(i)}
        self.byte = np.array([self.byte[b] for b in range(256)], np.int32)
        ids = {names[i]: i for i in plain}
        for c in sorted({c for p in ids for c in p} - ids.keys()):
            ids[c] = self.size + len(ids) - len(plain)
        self.unknown = self.size + len(ids) - len(plain)
        scores = sorted({model.get_score(i) for i in plain}, reverse=True)
        rank = {s: r for r, s in enumerate(scores)}
        merges = [(ids[p[:k]] << 20 | ids[p[k:]], rank[model.get_score(i)], i) for p, i in ids.items() if i < self.size for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
        keys = np.array([m[0] for m in merges], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank, self.merged = keys[order], np.array([m[1] for m in merges], np.int32)[order], np.array([m[2] for m in merges], np.int32)[order]
        # What a look-up without a hit (-1) finds.
        self.rank, self.merged = np.append(self.rank, NONE), np.append(self.merged, np.int32(-1))
        # The merge table, open addressing: two look-ups in three end at the first place.
        self.bits = int(len(keys) * 4).bit_length()
        self.slots = np.full(1 << self.bits, -1, np.int32)
        left = np.arange(len(keys))
        slot = self._slot(self.keys)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            mine = self.slots[slot] == left
            left, slot = left[~mine], (slot[~mine] + 1) & ((1 << self.bits) - 1)
        self.slot_keys = np.where(self.slots >= 0, self.keys[self.slots], -1)
        self.of_code = np.full(0x110000, self.unknown, np.int32)
        for c in ids:
            if len(c) == 1:
                self.of_code[ord(c)] = ids[c]
        # What each piece decodes to; the mark is a blank.
        known = set(plain)
        text = [names[i].replace(chr(MARK), " ").encode() if i in known else b"" for i in range(self.size)]
        for b, i in enumerate(self.byte):
            text[i] = bytes([b])
        self.length = np.array([len(t) for t in text], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.blob = np.frombuffer(b"".join(text), np.uint8)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def symbols(self, codes: np.ndarray) -> np.ndarray:
        return self.of_code[codes]

    def joins(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``NONE``: no merge) and merged symbol (-1) of neighbours; a negative symbol joins nothing."""
        keys = left.astype(np.int64) << 20 | right
        slot = self._slot(keys)
        here = self.slot_keys[slot]
        same = here == keys
        place = np.where(same, self.slots[slot], -1)
        look = np.flatnonzero(~same & (here >= 0))
        slot = slot[look]
        while len(look):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            here = self.slot_keys[slot]
            same = here == keys[look]
            place[look[same]] = self.slots[slot[same]]
            go = ~same & (here >= 0)
            look, slot = look[go], slot[go]
        return self.rank[place], self.merged[place]


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _token(place: np.ndarray, merged: np.ndarray) -> np.ndarray:
    """What a candidate is known by in draws."""
    return mix((place.astype(np.uint64) << np.uint64(32)) + merged.astype(np.int64).view(np.uint64))


def _stays(keys: np.ndarray, token: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the keyed hash lets each candidate stay."""
    return mix(keys ^ token) >= np.uint64(min(dropout * 2.0**64, 2.0**64 - 2048))


def _kept(keys: np.ndarray, place: np.ndarray, merged: np.ndarray, dropout: float) -> np.ndarray:
    if dropout <= 0:
        return merged >= 0
    return (merged >= 0) & _stays(keys, _token(place, merged), dropout)


def _agenda_rows(v: Vocabulary, symbols: np.ndarray, keys: np.ndarray, dropout: float, met: list | None = None) -> np.ndarray:
    """Segments rows of symbols (-1 behind a row's end) all together; merged-away places become -1.

    ``met`` gets (row, place, merge) of the candidates that came up.
    """
    rows, width = symbols.shape
    wide = width + 1  # a column that holds no symbol stands between the rows
    sym = np.full((rows, wide), -1, np.int32)
    sym[:, :width] = symbols
    sym = sym.ravel()
    after = np.arange(1, rows * wide + 1, dtype=np.int32)
    after[-1:] -= 1
    ahead = np.arange(-1, rows * wide - 1, dtype=np.int32)
    ranks = np.full((rows, wide), NONE, np.int32)
    rank = ranks.ravel()
    merged = np.full(rows * wide, -1, np.int32)

    def enter(at):
        """Candidates that begin at these places."""
        r, m = v.joins(sym[at], sym[after[at]])
        if met is not None or dropout > 0:
            some = np.flatnonzero(m >= 0)
            row, place = np.divmod(at[some], wide)
            if met is not None:
                met.append((row, place, m[some]))
            if dropout > 0:
                r[some[~_kept(keys[row], place, m[some], dropout)]] = NONE
        rank[at], merged[at] = r, m

    enter(np.flatnonzero(sym >= 0))
    row = np.arange(rows)
    while len(row):
        at = row * wide + ranks[row].argmin(1)
        go = rank[at] < NONE
        row, at = row[go], at[go]
        right = after[at]
        sym[at], sym[right] = merged[at], -1
        rank[right] = NONE
        follow = after[right]
        after[at], ahead[follow] = follow, at
        enter(np.concatenate([at, ahead[at]]))
    return sym.reshape(rows, wide)[:, :width]


def _agenda_long(v: Vocabulary, symbols: np.ndarray, key: np.uint64, dropout: float) -> np.ndarray:
    """One long unit, with a heap."""
    n, symbols = len(symbols), symbols.copy()
    after, ahead = np.arange(1, n + 1), np.arange(-1, n - 1)

    def enter(places):
        places = places[after[places] < n]
        r, m = v.joins(symbols[places], symbols[after[places]])
        stay = _kept(np.full(len(places), key), places, m, dropout)
        return zip(r[stay].tolist(), places[stay].tolist(), m[stay].tolist(), symbols[places[stay]].tolist(), symbols[after[places[stay]]].tolist())

    heap = list(enter(np.arange(n)))
    heapq.heapify(heap)
    while heap:
        _, place, m, left, right_symbol = heapq.heappop(heap)
        right = after[place]
        if symbols[place] != left or right >= n or symbols[right] != right_symbol:
            continue
        symbols[place], symbols[right] = m, -1
        after[place] = after[right]
        if after[right] < n:
            ahead[after[right]] = place
        for item in enter(np.array([p for p in (place, ahead[place]) if p >= 0])):
            heapq.heappush(heap, item)
    return symbols


def encode_block(v: Vocabulary, texts: list[str], keys: np.ndarray, dropout: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of all texts one after the other, and how many stand before each text (the total last).

    ``keys`` is the number that a text's draws come from.
    """
    marked = [chr(MARK) + t if t else "" for t in texts]
    codes = np.frombuffer("".join(marked).encode("utf-32-le"), np.uint32)
    length = np.fromiter(map(len, marked), np.int64, len(marked))
    at = np.concatenate([[0], np.cumsum(length)])
    if not len(codes):
        return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
    literal = codes == MARK
    literal[at[:-1][length > 0]] = False
    codes = np.where(codes == 0x20, np.uint32(MARK), codes)
    symbols = v.symbols(codes)
    symbols[literal] = v.unknown
    mark = (codes == MARK) & ~literal
    begins = mark.copy()
    begins[1:] &= ~mark[:-1]
    feed = codes == FEED
    begins |= feed
    begins[1:] |= feed[:-1]
    begins[at[:-1][length > 0]] = True
    starts = np.flatnonzero(begins)
    sizes = np.diff(np.append(starts, len(codes)))
    first = np.searchsorted(starts, at)  # units before each text
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    number = np.arange(len(starts)) - first[owner]
    own = mix(keys[owner] + mix(number.astype(np.uint64) + np.uint64(seed)))

    # A hash of each unit's characters: a polynomial over prefix sums of some of them at a time, then scrambled.
    unit = np.empty(len(starts), np.uint64)
    cuts = [0]
    while cuts[-1] < len(starts):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(starts, starts[cuts[-1]] + HASHED))))
    for a, b in zip(cuts, cuts[1:]):
        low, high = starts[a], starts[b - 1] + sizes[b - 1]
        power, inverse = (np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(high - low, base, np.uint64)])) for base in (_BASE, pow(int(_BASE), -1, 1 << 64)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes[low:high].astype(np.uint64) + literal[low:high] + np.uint64(1)) * power[:-1])])
        s = starts[a:b] - low
        unit[a:b] = mix((sums[s + sizes[a:b]] - sums[s]) * inverse[s] + sizes[a:b].astype(np.uint64))
    _, one, which = np.unique(unit, return_index=True, return_inverse=True)

    def rows_of(part, high):
        inside = np.arange(high) < sizes[part][:, None]
        return inside, np.where(inside, symbols[np.minimum(starts[part][:, None] + np.arange(high), len(codes) - 1)], -1).astype(np.int32)

    def segment(some, rate, met=None):
        """Symbols of these units one after the other, merged-away places -1; ``met`` gets (index, place, merge) of candidates."""
        size = sizes[some]
        out = np.full(int(size.sum()), -1, np.int32)
        base = np.cumsum(size) - size
        for low, high in ((0, 4), (4, 8), (8, 12), (12, 20), (20, 32), (32, LONG)):
            fit = np.flatnonzero((size > low) & (size <= high))
            for part in np.array_split(fit, max(1, len(fit) * high // CELLS)):
                if len(part):
                    inside, rows = rows_of(some[part], high)
                    came = None if met is None else []
                    out[ragged(base[part], size[part])] = _agenda_rows(v, rows, own[some[part]], rate, came)[inside]
                    if came:
                        met += [(part[r], p, m) for r, p, m in came]
        for k in np.flatnonzero(size > LONG):
            s = starts[some[k]]
            out[base[k] : base[k] + size[k]] = _agenda_long(v, symbols[s : s + size[k]], own[some[k]], rate)
        return out

    def other_draws(some, group, lead, met):
        """Which units draw otherwise than their group's leader for a candidate it met, and a hash of what they skip there.

        Without leaders the groups have run without dropout: they have skipped nothing.
        """
        at, place, merge = (np.concatenate(x) for x in zip(*met))
        order = np.argsort(at, kind="stable")
        at, place, merge = at[order], place[order], merge[order]
        candidate = _token(place, merge)
        stays = np.ones(len(at), bool) if lead is None else _stays(own[lead[at]], candidate, dropout)
        first_met = np.searchsorted(at, np.arange(int(group.max()) + 2))
        many = np.diff(first_met)[group]
        token = mix(np.arange(len(at)).astype(np.uint64) + np.uint64(1))
        differs, pattern = np.zeros(len(some), bool), np.zeros(len(some), np.uint64)
        total = np.cumsum(many)
        for part in np.split(np.arange(len(some)), np.flatnonzero(np.diff(total // DRAWS)) + 1):
            asked = ragged(first_met[group[part]], many[part])
            kept = _stays(np.repeat(own[some[part]], many[part]), candidate[asked], dropout)
            edge = np.concatenate([[0], np.cumsum(many[part])])
            wrong = np.concatenate([[0], np.cumsum(kept != stays[asked])])
            skips = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.where(kept, np.uint64(0), token[asked]))])
            differs[part] = wrong[edge[1:]] > wrong[edge[:-1]]
            pattern[part] = skips[edge[1:]] - skips[edge[:-1]]
        return differs, pattern

    if dropout > 0:
        # Long units have so many candidates that nearly each occurrence skips one: all of them run with their draws.
        parts, runs, slot = [], [], np.empty(len(starts), np.int64)

        def run(some, rate, met=None):
            parts.append(segment(some, rate, met))
            runs.append(some)
            return sum(map(len, runs)) - len(some)

        long = np.flatnonzero(sizes > LONG)
        slot[long] = run(long, dropout) + np.arange(len(long))
        left = np.flatnonzero(sizes <= LONG)
        short = sizes[one] <= LONG
        lead, group, rate = one[short], (np.cumsum(short) - 1)[which[left]], 0.0
        while len(left):
            met = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32))]
            slot[left] = run(lead, rate, met) + group
            differs, pattern = other_draws(left, group, lead if rate else None, met)
            left, group = left[differs], group[differs]
            _, first_of, group = np.unique(mix(pattern[differs] + mix(group.astype(np.uint64))), return_index=True, return_inverse=True)
            lead, rate = left[first_of], dropout
            if len(lead) > ALONE * len(left):
                slot[left] = run(left, dropout) + np.arange(len(left))
                break
        out, one, which = np.concatenate(parts), np.concatenate(runs), slot
    else:
        out = segment(one, 0.0)
    size = sizes[one]
    base = np.cumsum(size) - size

    # Symbols without a piece become the bytes of their character.
    bare = np.flatnonzero(out >= v.size)
    if len(bare):
        source = ragged(starts[one], size)[bare]
        raw = [chr(c).encode() for c in codes[source].tolist()]
        count = np.ones(len(out), np.int64)
        count[bare] = [len(r) for r in raw]
        wide = np.repeat(out, count)
        begin = (np.cumsum(count) - count)[bare]
        wide[ragged(begin, count[bare])] = v.byte[np.frombuffer(b"".join(raw), np.uint8)]
        edge = np.concatenate([[0], np.cumsum(count)])
        size_wide = edge[base + size] - edge[base]
        out, size, base = wide, size_wide, edge[base]
    live = out >= 0
    edge = np.concatenate([[0], np.cumsum(live)])
    pieces, begin = out[live], edge[base]
    many = edge[base + size] - begin
    total = np.concatenate([[0], np.cumsum(many[which])])
    return pieces[ragged(begin[which], many[which])], total[first]


def decode_block(v: Vocabulary, pieces: np.ndarray, before: np.ndarray) -> list[bytes]:
    """The text of each run of pieces, in UTF-8."""
    length = v.length[pieces]
    flat = v.blob[ragged(v.begin[pieces], length)].tobytes()
    edge = np.concatenate([[0], np.cumsum(length)])[before].tolist()
    return [flat[a + 1 : b] if b > a else b"" for a, b in zip(edge, edge[1:])]


def _keys(ids: pa.Array, seed: int) -> np.ndarray:
    return mix(np.asarray(ids.fill_null(0), np.int64).view(np.uint64) + mix(np.array([seed], np.uint64)))


def encode(docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """``doc_id, n_pieces, lossless`` and the ``pieces`` (or, with ``digest``, ``pieces_sha256`` of them as 32-bit numbers).

    ``lossless`` tells whether decoding the pieces has given back the very bytes of the text.
    """

    def run(batches):
        v = vocabulary(model)
        for batch in batches:
            for part in blocks(batch, limit=BLOCK):
                texts = part.column(1).fill_null("")
                pieces, before = encode_block(v, texts.to_pylist(), _keys(part.column(0), seed), dropout, seed)
                flat, at = text_of(texts)
                raw = flat.tobytes()
                same = [raw[a:b] == t for a, b, t in zip(at.tolist(), at[1:].tolist(), decode_block(v, pieces, before))]
                if digest:
                    held = pieces.astype("<i4").tobytes()
                    edge = (before * 4).tolist()
                    last = pa.array([hashlib.sha256(held[a:b]).hexdigest() for a, b in zip(edge, edge[1:])], pa.string())
                else:
                    last = pa.ListArray.from_arrays(pa.array(before.astype(np.int32)), pa.array(pieces))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(before)), pa.array(same, pa.bool_()), last], names=["doc_id", "n_pieces", "lossless", "pieces_sha256" if digest else "pieces"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_pieces long, lossless boolean, {'pieces_sha256 string' if digest else 'pieces array<int>'}")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id, text`` of rows with ``doc_id, pieces``; null pieces give the empty text."""

    def run(batches):
        v = vocabulary(model)
        for batch in batches:
            lists = [np.asarray(x or [], np.int64) for x in batch.column(1).to_pylist()]
            before = np.concatenate([[0], np.cumsum([len(x) for x in lists], dtype=np.int64)]) if lists else np.zeros(1, np.int64)
            texts = decode_block(v, np.concatenate(lists) if lists else np.zeros(0, np.int64), before)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([t.decode() for t in texts], pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long"), "pieces").mapInArrow(run, "doc_id long, text string")
