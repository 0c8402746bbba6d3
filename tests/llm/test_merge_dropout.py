import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece

from rowtide.llm.blocks import blocks, mix
from rowtide.llm.merge_dropout import BLOCK, _agenda_long, _agenda_rows, decode, encode, encode_block, vocabulary
from tests.llm.data import docs_of, odd_texts, peak_mb, rows, same_rows, table, words

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", "a  b", " x ", "a\n\n b", "日本語 テスト\r\n", "😀 x😀", "aaaa" * 100, "\x00\tq", "é" * 200, "   lots   of    spaces  ", " " * 100, "ab" * 3000, "<s> hello </s>"]


def pieces_of(texts, dropout, seed=17):
    p, before = encode_block(vocabulary(MODEL), texts, np.arange(len(texts)).astype(np.uint64), dropout, seed)
    return [p[a:b].tolist() for a, b in zip(before, before[1:])]


def test_without_dropout_the_pieces_are_the_librarys(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = TEXTS + [r.text for r in table(spark, "documents").limit(60).collect()]
    assert pieces_of(texts, 0.0) == library.encode(texts)


def test_lossless_at_every_rate(spark):
    docs = table(spark, "documents")
    for dropout in (0.1, 0.7, 1.0):
        encoded = encode(docs, MODEL, dropout)
        assert encoded.where("not lossless").count() == 0
        assert same_rows(rows(decode(encoded, MODEL)), rows(docs.select("doc_id", "text")))


def test_dropout_varies_and_repeats_by_key():
    text = ["the quick brown fox jumps over the lazy dog and the other animals " * 20] * 5
    plain, one, again, other = pieces_of(text, 0.0), pieces_of(text, 0.2), pieces_of(text, 0.2), pieces_of(text, 0.2, seed=18)
    assert one == again != other and len({tuple(p) for p in one}) == 5
    assert all(len(a) > len(b) for a, b in zip(one, plain))
    characters = pieces_of(text, 1.0)
    assert len(characters[0]) == len(text[0]) + 1
    rate = [len(pieces_of(text, d)[0]) for d in (0.0, 0.1, 0.3, 0.6, 1.0)]
    assert rate == sorted(rate)


def test_both_agendas_agree():
    v = vocabulary(MODEL)
    rng = np.random.default_rng(1)
    letters = v.symbols(np.array([ord(c) for c in "▁theaoinsr"], np.uint32))
    rows_ = letters[rng.integers(0, len(letters), (200, 40))].astype(np.int32)
    keys = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    for dropout in (0.0, 0.15, 0.5):
        wide = _agenda_rows(v, rows_, keys, dropout)
        for k in range(200):
            assert (wide[k] == _agenda_long(v, rows_[k], keys[k], dropout)).all()


def test_odd_texts_and_digest(spark):
    docs = docs_of(spark, odd_texts())
    encoded = encode(docs, MODEL)
    assert same_rows(rows(decode(encoded, MODEL)), [(i, t or "") for i, t in odd_texts()])
    listed = [(r.doc_id, r.n_pieces, True, hashlib.sha256(np.array(r.pieces, "<i4").tobytes()).hexdigest()) for r in encoded.collect()]
    assert same_rows(rows(encode(docs, MODEL, digest=True)), listed)
    assert [n for i, n, *_ in listed if i in (1, 2)] == [0, 0]


def test_empty(spark):
    assert rows(encode(docs_of(spark, []), MODEL)) == []
    assert rows(decode(encode(docs_of(spark, []), MODEL), MODEL)) == []


def each_alone(text, key, dropout, seed=17):
    """Each unit of a text without literal marks or unknown characters by the agenda of long units, with its own draws."""
    v, out = vocabulary(MODEL), []
    for number, word in enumerate(text.split(" ")):
        symbols = v.symbols(np.array([0x2581, *map(ord, word)], np.uint32))
        own = mix(np.array([key], np.uint64) + mix(np.array([number + seed], np.uint64)))[0]
        got = _agenda_long(v, symbols, own, dropout)
        out += got[got >= 0].tolist()
    return out


def test_each_occurrence_is_the_agenda_with_its_own_draws():
    texts = [r"the quick international documentation " * 30 + "z", "another understanding of the " * 50 + "long" * 30]
    for dropout in (0.1, 0.5, 1.0):
        assert pieces_of(texts, dropout) == [each_alone(t, k, dropout) for k, t in enumerate(texts)]


def test_occurrences_of_a_word_are_not_capped():
    seen, n = {}, 4000
    for p in pieces_of(["international"] * n, 0.1):
        seen[tuple(p)] = seen.get(tuple(p), 0) + 1
    assert len(seen) > 16
    plain = pieces_of(["of"], 0.0)[0]
    varied = [sum(p != plain for p in pieces_of(["of"] * n, 0.1, seed)) for seed in range(5)]
    assert all(0.05 * n < x < 0.4 * n for x in varied)


def plain_pieces(text, key, dropout, seed=17):
    """Lists of strings, merged one pair at a time by the vocabulary file's scores; a pair is drawn when it first stands there."""
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    size = library.get_piece_size()
    score = {library.id_to_piece(i): library.get_score(i) for i in range(size) if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))}
    number_of = {p: library.piece_to_id(p) for p in score}
    mask = (1 << 64) - 1

    def scramble(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    out = []
    for number, word in enumerate(text.split(" ")):
        own = scramble((key + scramble((number + seed) & mask)) & mask)
        parts = [(k, c) for k, c in enumerate("\u2581" + word)]
        skipped, stays = set(), {}
        while True:
            best = None
            for k in range(len(parts) - 1):
                (a, left), (_, right) = parts[k], parts[k + 1]
                if left + right not in score:
                    continue
                now = (a, left, right)
                if now not in stays:
                    draw = scramble(own ^ scramble(((a << 32) + number_of[left + right]) & mask))
                    stays[now] = draw >= min(dropout * 2.0**64, 2.0**64 - 2048)
                if stays[now] and (best is None or score[left + right] > best[0]):
                    best = (score[left + right], k)
            if best is None:
                break
            k = best[1]
            parts[k : k + 2] = [(parts[k][0], parts[k][1] + parts[k + 1][1])]
        out += [number_of[p] for _, p in parts]
    return out


def test_pieces_are_those_of_a_plain_merge_loop(spark):
    words_ = [w for r in table(spark, "documents").where("lang = 'en'").limit(12).collect() for w in (r.text or "").split() if w.isascii() and w.isalpha()]
    texts = [" ".join(words_[i : i + 150]) for i in range(0, 900, 150)] + ["international internationally documentation " * 40 + "a" * 70]
    for dropout in (0.1, 0.35, 0.8):
        assert pieces_of(texts, dropout) == [plain_pieces(t, k, dropout) for k, t in enumerate(texts)]


def test_a_block_takes_little_memory():
    batch = pa.RecordBatch.from_arrays([pa.array([" ".join(words(60, i, 5000)) for i in range(6000)])], names=["text"])
    v, many = vocabulary(MODEL), []

    def run():
        for part in blocks(batch, limit=BLOCK):
            many.append(len(encode_block(v, part.column(0).to_pylist(), np.arange(part.num_rows).astype(np.uint64), 0.1, 17)[0]))

    assert peak_mb(run) < 45
    assert len(many) > 1 and sum(many) > 6000 * 60


def test_units_are_told_apart_over_a_long_text(monkeypatch):
    texts = [" ".join(words(3000, i)) + "x" * 200 for i in range(3)] + TEXTS
    expected = pieces_of(texts, 0.1)
    for name in ("HASHED", "CELLS", "DRAWS"):
        monkeypatch.setattr(f"rowtide.llm.merge_dropout.{name}", 100)
    assert pieces_of(texts, 0.1) == expected
