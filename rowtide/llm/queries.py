"""The dealt operators as queries over the given tables, with production parameters, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.conversations import damaged, repair
from rowtide.llm.decontamination import row_contamination
from rowtide.llm.language_id import fit, held_out, identify
from rowtide.llm.lexical_search import search
from rowtide.llm.line_dedup import remove_repeats
from rowtide.llm.merge_dropout import encode
from rowtide.llm.near_dedup import near_duplicates
from rowtide.llm.neighbours import nearest
from rowtide.llm.quality import resample
from rowtide.llm.quality_rules import quality_rules
from rowtide.llm.secret_scan import find_secrets, learn_words
from rowtide.llm.token_counts import token_counts
from rowtide.llm.warc import read_archives, write_archives
from rowtide.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PIECES = "piece_bpe_32k.model"


def query(oracle: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return add


# ---- the same in DuckDB

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR = rf"""
    with recursive words as (
        select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
    shingles as (
        select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as s
        from (select doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) as i from words where len(w) > 0)),
    sizes as (select doc_id, count(*) as n from shingles group by doc_id),
    pairs as (
        select a.doc_id as x, b.doc_id as y, count(*) as shared
        from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
    links as (
        select x, y from pairs join sizes p on p.doc_id = x join sizes q on q.doc_id = y
        where 100 * shared >= 85 * (p.n + q.n - shared)),
    arcs as (select x, y from links union all select y, x from links),
    reach as (
        select doc_id, doc_id as r from documents
        union select reach.doc_id, arcs.y from reach join arcs on arcs.x = reach.r)
    select d.doc_id, coalesce(n, 0) as n_shingles, c as component_id, d.doc_id = c as kept
    from documents d join (select doc_id, min(r) as c from reach group by doc_id) using (doc_id)
    left join sizes using (doc_id)"""

_CONTAMINATED = rf"""
    with items as (
        select item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
    windows as (
        select distinct item_id, list_slice(w, i, i + 12) as g
        from (select item_id, w, unnest(range(1, greatest(2, len(w) - 11))) as i from items where len(w) > 0)),
    docs as (
        select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
    places as (
        select doc_id, i, n, list_slice(w, i, i + n - 1) as g
        from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
              from docs, (select distinct len(g) as n from windows) where len(w) >= n)),
    found as (select doc_id, i, n, item_id from places join windows using (g)),
    hits as (
        select doc_id, count(distinct p) as n_hit
        from (select doc_id, unnest(range(i, i + n)) as p from found) group by doc_id),
    listed as (
        select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids
        from (select distinct doc_id, cast(item_id as varchar) as id from found) group by doc_id)
    select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
           sha256(coalesce(ids, '')) as items_sha256,
           coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
    from docs left join hits using (doc_id) left join listed using (doc_id)"""

_WARC = """
    with digests as (
        select page_id, strlen(coalesce(html, '')) as n, sha1(coalesce(html, '')) as x from pages),
    groups as (select *, max(page_id) over (partition by x, n) as original from digests)
    select page_id, cast(n as bigint) as payload_bytes,
           list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               cast((cast('0x' || substr(x, cast(i // 4 * 5 + 1 as bigint), 5) as bigint) >> (15 - 5 * (i % 4))) & 31 as bigint) + 1, 1)),
               'string_agg', '') as payload_digest,
           case when page_id = original then 'response' else 'revisit' end as record_type,
           case when page_id <> original then original end as refers_to
    from groups"""

_RULES = r"""
    with cut as materialized (
        select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as t,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
               list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
        from documents),
    words as materialized (select r, unnest(w) as a, unnest(range(len(w))) as i from cut),
    windows as (select x.r, x.i, x.a, y.a as b, z.a as c from words x join words y on y.r = x.r and y.i = x.i + 1 join words z on z.r = x.r and z.i = x.i + 2),
    twice as (select r, unnest(list(i)) as i from windows group by r, a, b, c having count(*) > 1),
    again as (select r, count(distinct p) as n from (select r, unnest(range(i, i + 3)) as p from twice) group by r),
    counts as materialized (
        select cut.r, doc_id, lang, source, cast(len(w) as bigint) as n_words, cast(len(l) as bigint) as n_lines,
               cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as bigint) as word_chars,
               cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
               cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, coalesce(n, 0) as n_repeat_words
        from cut left join again using (r)),
    rates as (
        select r, lang, source, unnest(['word_length', 'symbols', 'repeated_lines', 'repeated_words']) as rule,
               unnest([1000 * word_chars // n_words, 1000 * n_symbols // n_words, 1000 * n_dup_lines // n_lines, 1000 * n_repeat_words // n_words]) as v
        from counts where n_words > 0),
    shifted as (select *, greatest(length(bin(v)) - 6, 0) as s from rates),
    floors as (select *, (v >> s) << s as f from shifted),
    levels as (
        select 1 as level, lang, source, rule, f from floors union all
        select 2, lang, null, rule, f from floors union all
        select 3, null, null, rule, f from floors),
    ranked as (
        select *, row_number() over (partition by level, lang, source, rule order by f) as k,
               count(*) over (partition by level, lang, source, rule) as total from levels),
    quartiles as (
        select level, lang, source, rule, max(total) as n, min(f) filter (where 4 * k >= total) as q1, min(f) filter (where 4 * k >= 3 * total) as q3
        from ranked group by all),
    fences as (
        select *, case rule when 'word_length' then q1 - 3 * spread else -1 end as low, q3 + 3 * spread as high
        from (select *, greatest(q3 - q1, case rule when 'word_length' then 500 when 'symbols' then 50 else 100 end) as spread from quartiles)),
    chosen as (
        select distinct on (r, rule) x.r, x.rule, v < low or v > high as beyond
        from rates x join fences f on f.rule = x.rule and (f.n >= 200 or f.level = 3)
             and (f.level = 3 or f.lang is not distinct from x.lang) and (f.level > 1 or f.source is not distinct from x.source)
        order by x.r, x.rule, f.level),
    verdicts as (select r, string_agg(rule, ',' order by rule) filter (where beyond) as failed from chosen group by r)
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, coalesce(failed, '') as failed,
           n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
           not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and failed is null as kept
    from counts left join verdicts using (r)"""

_SEARCH = rf"""
    with words as (
        select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
    sizes as (select doc_id, cast(len(w) as bigint) as n from words where len(w) > 0),
    totals as (select count(*) as docs, cast(sum(n) as bigint) as l from sizes),
    asked as (
        select item_id, term, count(*) as times
        from (select item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
        group by all),
    postings as (
        select doc_id, term, count(*) as tf from (select doc_id, unnest(w) as term from words)
        where term in (select term from asked) group by all),
    weights as (
        select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as weight
        from postings, totals group by term, docs),
    impacts as (
        select doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // l))) as impact
        from postings join weights using (term) join sizes using (doc_id), totals),
    scores as (
        select item_id, doc_id, cast(sum(times * impact) as bigint) as score
        from asked join impacts using (term) group by all having sum(times * impact) > 0)
    select item_id, cast(rank as integer) as rank, doc_id, score
    from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores) where rank <= 20"""

_REPAIR = r"""
    with recursive keyed as (
        select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
               xor(list_reduce(list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda c: cast(ascii(c) as bigint)),
                   lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, case when x % 2 = 1 then 3988292384 else 0 end), xor(c, b)), 4294967295), 4294967295) % 20 as kind
        from conversations),
    hurt as (
        select conv_id, turn, case kind when 4 then 'user' else role end as role,
               case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
        from keyed, lateral (select unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end))) where kind <> 0),
    placed as materialized (
        select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
               right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as e, left(role, 1) as initial
        from hurt),
    faults as materialized (
        select *, e = '' as blank, e <> '' and again as dup, e <> '' and not again and e not in ('.', '!', '?') as trunc
        from (select *, lag(initial) over (partition by conv_id order by i) as ahead,
                     row_number() over (partition by conv_id, role, text order by i) > 1 as again from placed)),
    counts as (
        select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
               count(*) filter (where blank) as blank, count(*) filter (where dup) as duplicate,
               count(*) filter (where trunc) as truncated,
               count(*) filter (where i > 1 and ahead || initial not in ('su', 'ua', 'au')) as illegal
        from faults group by conv_id),
    inserts(s, t, n) as (values (0, 0, 0), (0, 2, 1), (0, 3, 2), (1, 1, 0), (1, 2, 1), (1, 3, 2), (2, 2, 0), (2, 3, 1), (3, 3, 0), (3, 2, 1)),
    moves(initial, s, t) as (values ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
    letters(letter) as (values ('D'), ('K'), ('R')),
    arcs as materialized (
        select f.conv_id, f.i, n.s, case letter when 'D' then n.t when 'K' then m.t when 'R' then case n.t when 2 then 3 else 2 end end as t,
               3 * n.n + case letter when 'D' then 4 when 'K' then 0 else 3 end + case when trunc and letter <> 'D' then 3 else 0 end as cost,
               repeat('I', n.n) || letter as step
        from faults f cross join inserts n cross join letters left join moves m on m.initial = f.initial and m.s = n.t
        where letter = 'D' or not (blank or dup) and (letter = 'R' or m.t is not null)),
    walk as (
        select conv_id, cast(0 as bigint) as i, 0 as s, struct_pack(cost := 0, audit := '') as best from counts
        union all
        select w.conv_id, a.i, a.t, min(struct_pack(cost := w.best.cost + a.cost, audit := w.best.audit || a.step))
        from walk w join arcs a on a.conv_id is not distinct from w.conv_id and a.i = w.i + 1 and a.s = w.s
        group by w.conv_id, a.i, a.t),
    repairs as materialized (
        select w.conv_id, min(struct_pack(cost := best.cost + 3 * x.n, audit := best.audit || repeat('I', x.n))) as best
        from walk w join counts c on c.conv_id is not distinct from w.conv_id and c.n = w.i join inserts x on x.s = w.s and x.t in (0, 3)
        group by w.conv_id),
    steps as (select conv_id, unnest(string_split(best.audit, '')) as letter, unnest(range(len(best.audit))) as nth from repairs where best.audit <> ''),
    used as (select *, sum(case when letter = 'I' then 0 else 1 end) over (partition by conv_id order by nth) as i from steps),
    stay as (
        select u.conv_id, u.nth, u.letter, f.role, f.text, row_number() over (partition by u.conv_id order by u.nth) as k,
               first_value(u.letter = 'K' and f.initial = 's') over (partition by u.conv_id order by u.nth) as has_system
        from used u left join faults f on f.conv_id is not distinct from u.conv_id and f.i = u.i and u.letter <> 'I' where u.letter <> 'D'),
    turns as (
        select conv_id, nth, case letter when 'K' then role else case when (k - 1 - cast(has_system as integer)) % 2 = 0 then 'user' else 'assistant' end end || ':' || coalesce(text, '') as turn
        from stay),
    texts as (select conv_id, string_agg(turn, chr(10) order by nth) as whole from turns group by conv_id)
    select d.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
           coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce(best.cost, 0) as bigint) as cost,
           coalesce(best.audit, '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
    from (select distinct conv_id from conversations) d
    left join counts c on c.conv_id is not distinct from d.conv_id
    left join repairs r on r.conv_id is not distinct from d.conv_id
    left join texts t on t.conv_id is not distinct from d.conv_id"""


# ---- the queries


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")


@query(_NEAR)
def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query()
def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


@query()
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return find_secrets(docs, words=learn_words(docs))


@query()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


@query()
def op6_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
    return resample(table(spark, sf_dir, "documents"), good)


@query(_CONTAMINATED)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return row_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_units", F.size("removed").cast("long").alias("n_removed"), spans.alias("removed"), F.sha2("text", 256).alias("text_sha256"))


@query()
def op9_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES), digest=True)


@query(_WARC)
def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    records = read_archives(spark, path, payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query(_SEARCH)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query(_REPAIR)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")), times_col="times")


@query(_RULES)
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules(table(spark, sf_dir, "documents"))
    failed = F.array_join(F.sort_array("failed"), ",").alias("failed")
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed, "base_failed", "kept")
