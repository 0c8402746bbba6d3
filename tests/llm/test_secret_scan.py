import hashlib
import math
import random
import re
import time

from rowtide.llm import secret_scan
from rowtide.llm.secret_scan import FIXED, base_spans, find_secrets, guess_spans, guesses, learn_words, mask_secrets, scan
from tests.llm.data import docs_of, odd_texts, rows, same_rows, table


def brute(text):
    """The patterns as they are written down, letter by letter."""
    out = []
    either = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
    for m in re.finditer(rf"""({either})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_given_documents(spark):
    docs = table(spark, "documents", "/root/testdata/sf0.01")
    got = {r.doc_id: r for r in find_secrets(docs).collect()}
    some = 0
    for doc, text in rows(docs.select("doc_id", "text")):
        base = brute(text)
        some += len(base)
        names = ["assign", "access", "hex"]
        assert (got[doc].n_assign, got[doc].n_access, got[doc].n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
        listed = [f"{names[k]}:{s}:{e}" for s, k, e in base]
        assert got[doc].base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(got[doc].spans.split(",")) or not listed
    assert some > 20 and len(got) == docs.count()


def test_patterns_on_edges():
    for text in [
        "PASSWORD = 'abcdef'",
        "secret: token: abcdefgh",
        "password=token=abcdef",
        "token==abcdefg",
        "ſecret: abcdefgh toKen: abcdefgh",
        "api_key:abc api_key:abcdef apikey = \"k.k-k_k\"",
        "AKIAAKIA" + "A" * 12,
        "AKIA" + "A" * 15,
        "a" * 23 + " " + "b" * 24,
        "😀 token: 123456",
        "password  :  short",
        "token=" + "0123456789abcdef" * 3,
    ]:
        assert base_spans(text) == brute(text), text


def test_guess_cost_finds_the_cheapest_segmentation():
    assert guesses("password") < 3 < guesses("pxqvbzwj")
    assert guesses("1990-05-17") < guesses("7#kR!vQ2zx")
    assert guesses("qwertyuiop") < 5 and guesses("aaaaaaaaaaaa") < 5
    assert guesses("password1999") < guesses("password") + 3.5
    assert guesses("aaaaaaaaXk3#9vQz") > 10
    assert guesses("k9#" * 100) > 10


def test_context_values(spark):
    text = 'the passphrase is "vR7#kQ2!mZx9" but the password is required, and pwd: letmein'
    spans = guess_spans(text, [])
    assert [text[s:e] for s, _, e in spans] == ["vR7#kQ2!mZx9"]
    base, every = scan("token: abcdef0123456789 and auth: zX9!kd#2@Lpq7")
    assert len(base) == 1 and len(every) == 2 and every[0] in base


def test_odd_texts_and_mask(spark):
    texts = odd_texts() + [(20, "a token: abcdefgh1 b"), (21, "AKIA" + "Q" * 16 + " " + "ab12" * 7)]
    docs = docs_of(spark, texts)
    got = find_secrets(docs)
    assert same_rows(rows(got.select("doc_id", "n_assign", "n_access", "n_hex")), [(i, *(sum(k == n for _, k, _ in brute(t or "")) for n in range(3))) for i, t in texts])
    masked = mask_secrets(docs)
    assert masked.columns == docs.columns
    assert {r.doc_id: r.text for r in masked.where("doc_id >= 20").collect()} == {20: "a [SECRET] b", 21: "[SECRET] [SECRET]"}
    assert same_rows(rows(masked.where("doc_id < 20 or doc_id is null").select("doc_id", "text")), odd_texts())


def test_empty(spark):
    assert rows(find_secrets(docs_of(spark, []))) == [] == rows(mask_secrets(docs_of(spark, [])))


def test_values_that_go_on_behind_a_pattern_or_inside_another_value(spark):
    cases = [
        ("password: abc123!Zx9#kQ2vR7", "abc123!Zx9#kQ2vR7", "[SECRET]"),
        ('{"token":"abcdef","pwd":"vR7#kQ2!mZx9"}', "vR7#kQ2!mZx9", '{"[SECRET]","pwd":"[SECRET]"}'),
        ("token=abcdef&pwd=vR7kQ2mZx9w", "vR7kQ2mZx9w", "[SECRET]&pwd=[SECRET]"),
        ("login=bob;pwd=vR7#kQ2!mZx9;page=2", "vR7#kQ2!mZx9", "login=bob;pwd=[SECRET];page=2"),
        ("auth=required,pin:pwd=vR7#kQ2!mZx9", "pwd=vR7#kQ2!mZx9", "auth=required,pin:[SECRET]"),
        ("pwd='vR7#k\\'Q2!mZx9',x", "vR7#k\\'Q2!mZx9", "pwd='[SECRET]',x"),
        ("pwd='vR7#k'Q2!mZx9'", "vR7#k'Q2!mZx9", "pwd='[SECRET]'"),
    ]
    for text, value, _ in cases:
        assert [text[s:e] for s, k, e in scan(text)[1] if k == 3] == [value], text
    masked = mask_secrets(docs_of(spark, [(i, t) for i, (t, _, _) in enumerate(cases)]))
    assert {r.doc_id: r.text for r in masked.collect()} == {i: m for i, (_, _, m) in enumerate(cases)}


def test_nested_credential_words_take_time_in_proportion():
    began = time.perf_counter()
    scan("token=" * 50_000)
    assert time.perf_counter() - began < 20


def guesses_brute(value, words=secret_scan.FIXED):
    """Every segmentation's pieces, each start tried for each end."""
    low, n = value.lower(), len(value)
    plain, letter = low.translate(secret_scan._LEET), math.log10(secret_scan._alphabet(value))
    dates = {m.span() for m in secret_scan._DATE.finditer(value)}
    best = [0.0] + [math.inf] * n
    for j in range(1, n + 1):
        best[j] = best[j - 1] + letter
        for i in range(j):
            w, costs = low[i:j], []
            rank = words.rank.get(w) or words.rank.get(plain[i:j])
            if rank and j - i > 1:
                costs.append(math.log10(rank + 1) + ((value[i:j] != w) + (plain[i:j] != w)) * math.log10(4))
            if (i, j) in dates:
                costs.append(math.log10(365 * 120) if j - i > 4 else math.log10(120))
            if j - i > 1 and len(set(w)) == 1:
                costs.append(letter + math.log10(j - i))
            if j - i > 2 and all(x in secret_scan._STEPS for x in zip(w, w[1:])):
                costs.append(math.log10(40) + math.log10(j - i))
            best[j] = min([best[j], *(best[i] + c for c in costs)])
    return best[n]


def test_long_values_have_their_cheapest_segmentation():
    rng = random.Random(3)
    parts = ["aaaa", "password", "1999", "qwerty", "asas", "$$", "7#", "ss", "2000-01-01", "-" * 9, "0000", "summer", "zx"]
    for n in (3, 8, 20, 40):
        for _ in range(15):
            value = "".join(rng.choice(parts) for _ in range(n))
            for known in (secret_scan.FIXED, secret_scan.Words.of(["zxaaaa", "wertyp", "the"])):
                assert math.isclose(guesses(value, known), guesses_brute(value, known), rel_tol=1e-9), value
    assert guesses("-" * 300) < 4.1 and guesses("*" * 70) < 4
    assert scan("login: " + "-" * 200)[1] == [] == scan("token: " + "*" * 300)[1]
    began = time.perf_counter()
    assert guesses("asdf" * 25_000 + "-" * 100_000) > 4
    assert time.perf_counter() - began < 30


PROSE = [
    "login is impossible today",
    "auth: authentication failed",
    "the password is unbelievably important, said the administrator",
    "pin: pronunciation; token is responsibility",
    "pass: photosynthesis",
]


def test_words_are_learnt_by_the_rows_that_hold_them(spark):
    texts = [(i, "alpha alpha Beta" + (" gamma's" if i % 2 else "") + (" rare" if i < 9 else "")) for i in range(30)] + [(None, None), (40, ""), (41, "x" * 50 + " of")]
    got = learn_words(docs_of(spark, texts)).rank
    assert [got[w] for w in ("alpha", "beta", "gamma")] == [1, 2, 3] and not {"rare", "x" * 50, "s", ""} & set(got)
    assert got["the"] == 1 and got["of"] == FIXED.rank["of"]
    assert learn_words(docs_of(spark, [])) == FIXED
    assert "alpha" not in learn_words(docs_of(spark, texts), one_in=1).rank  # 30 of 33 rows are not every row


def test_prose_has_no_spans_and_secrets_stay_found(spark):
    secret = (100, "the passphrase is vR7#kQ2!mZx9 and pwd: kqzvbxwjtr")
    docs = docs_of(spark, [(i, PROSE[i % 5]) for i in range(50)] + [secret])
    assert any(scan(t)[1] for t in PROSE)
    words = learn_words(docs)
    assert {r.spans for r in find_secrets(docs, words=words).where("doc_id < 100").collect()} == {""}
    assert [r.text for r in mask_secrets(docs, words=words).where("doc_id = 100").collect()] == ["the passphrase is [SECRET] and pwd: [SECRET]"]
    assert sorted(r.text for r in mask_secrets(docs, words=words).where("doc_id < 100").collect()) == sorted(PROSE * 10)
