import public_tokenizers
import sentencepiece

from rowtide.llm.token_counts import counts, cut, processor, token_counts
from tests.llm.data import docs_of, odd_texts, rows, same_rows, table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def whole(text):
    return len(sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(text))


def test_counts_are_the_librarys(spark):
    docs = table(spark, "documents")
    got = rows(token_counts(docs, MODEL, segment=100))
    want = [(r.doc_id, len(r.text.encode()), n := whole(r.text), n > 4096) for r in docs.collect()]
    assert same_rows(got, want)


def test_odd_texts(spark):
    texts = odd_texts()
    got = rows(token_counts(docs_of(spark, texts), MODEL))
    want = [(i, len((t or "").encode()), n := whole(t or ""), n > 4096) for i, t in texts]
    assert same_rows(got, want)


def test_empty(spark):
    assert rows(token_counts(docs_of(spark, []), MODEL)) == []


def test_cuts_never_change_a_count():
    texts = ["a  b   c", "▁x ▁ y", "\n\n x \r\n", "é" * 30, "aaaa " * 20, "x" * 40, " " * 50, "日本語テキスト" * 9, "<s> </s> <unk>", "a\x00b"]
    for size in (1, 2, 3, 7, 16):
        assert counts(texts, MODEL, size) == [whole(t) for t in texts], size


def test_parts_hold_the_text():
    text = "some words, and   more\nof them " * 9
    parts = list(cut(text, processor(MODEL)[1], 10))
    assert parts[0] + "".join(p[1:] for p in parts[1:]) == text and len(parts) > 5
