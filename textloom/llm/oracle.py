"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from textloom.llm import licenses

QUALITY_RULES = r"""
with d as (
    select doc_id, coalesce(text, '') as t from documents
), w as (
    select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls
    from d
), places as (
    select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) > 2
), windows as (
    select doc_id, i, count(*) over (partition by doc_id, ws[i], ws[i + 1], ws[i + 2]) as n from places
), repeats as (
    select doc_id, count(distinct j) as n
    from (select doc_id, unnest([i, i + 1, i + 2]) as j from windows where n > 1)
    group by doc_id
), m as (
    select w.doc_id,
        len(ws)::bigint as n_words,
        coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::bigint as word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        (len(ls) - len(list_distinct(ls)))::bigint as n_dup_lines,
        coalesce(r.n, 0)::bigint as n_repeat_words,
        len(ls)::bigint as n_lines,
        length(regexp_replace(t, '[^A-Z]', '', 'g'))::bigint as n_upper,
        length(regexp_replace(t, '[^a-z]', '', 'g'))::bigint as n_lower
    from w left join repeats r on r.doc_id = w.doc_id
), f as (
    select *,
        (case when n_words < 50 then 1 else 0 end
            + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
            + case when 10 * n_symbols > n_words then 4 else 0 end
            + case when word_chars < 2 * n_words then 8 else 0 end
            + case when word_chars > 20 * n_words then 16 else 0 end
            + case when 100 * n_dup_lines > 30 * n_lines then 32 else 0 end
            + case when n_upper > n_lower then 64 else 0 end)::bigint as failed
    from m
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    (failed & 3) <> 0 as base_failed, failed = 0 as kept, failed, n_lines, n_upper, n_lower
from f
"""

TOP_K = """
with v as (
    select vec_id as id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v
    from embeddings
    where embedding is not null and len(embedding) > 0 and vec_id is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scores as (
    select q.id as query_id, p.id as vec_id,
        list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * p.v[i]))::bigint as score
    from v q join v p on q.id % 100 = 0 and p.id <> q.id
), ranked as (
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::integer as rank, vec_id, score
    from scores
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""

CHAT = r"""
with c as (
    select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as t from conversations
    union all
    select -1, 0, 'user', '</s>[INST] ok [/INST]'
    union all
    select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e as (
    select *,
        length(t) + len(regexp_extract_all(t, '<\\*/?s>|\[\\*(?:/?(?:INST|SYS|TURN)|ANS|ROLE)\]')) as escaped,
        length(r) + len(regexp_extract_all(r, '<\\*/?s>|\[\\*(?:/?(?:INST|SYS|TURN)|ANS|ROLE)\]')) as named
    from c
)
select conv_id,
    count(*)::bigint as n_turns,
    sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn, r, t)) as turns_sha256,
    coalesce(sum(length(t)) filter (where r = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(t, '' order by turn, r, t) filter (where r = 'assistant'), '')) as loss_sha256,
    (3 + sum(escaped + case r when 'user' then 13 when 'assistant' then 9 when 'system' then 11 else 19 + named end))::bigint
        as formatted_chars
from e
group by conv_id
"""

LICENSES = r"""
with phrases(phrase, label) as (values PHRASES),
templates(template, label, words) as (values TEMPLATES),
d as (
    select row_number() over () as r, doc_id,
        regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
    from documents
), w as (
    select r, unnest(ws) as word, unnest(range(len(ws))) as pos from d
), t as (
    select template, label, list_distinct(string_split(words, ' ')) as words,
        (1 << ceil(log2(len(string_split(words, ' '))))::integer)::bigint as stride
    from templates
), tw as (
    select template, label, stride, len(words) as m, unnest(words) as word from t
), shared as (
    select r, template, label, m, word, pos // stride as block from w join tw using (word)
    union all
    select r, template, label, m, word, pos // stride - 1 from w join tw using (word) where pos >= stride
), blocks as (
    select r, template, label, block, count(distinct word) / max(m)::double as containment
    from shared group by r, template, label, block
    having 5 * count(distinct word) >= 4 * max(m)
), runs as (
    select r, pos, concat_ws(' ', word, lead(word) over p, lead(word, 2) over p, lead(word, 3) over p) || ' ' as run
    from w window p as (partition by r order by pos)
), places as (
    select r, label, pos from runs join phrases on starts_with(run, phrase || ' ')
), base as (
    select r, count(*) as n, min(pos) as lo, max(pos) as hi,
        string_agg(distinct label, ',' order by label) as labels
    from places group by r
), every as (
    select r, string_agg(distinct label, ',' order by label) as labels
    from (select r, label from places union all select r, label from blocks) group by r
), best as (
    select r, max(containment) as score from blocks group by r
)
select d.doc_id, len(ws)::bigint as n_words, coalesce(base.n, 0)::bigint as n_base,
    base.lo::bigint as first_word, base.hi::bigint as last_word,
    coalesce(base.labels, '') as base_labels, coalesce(every.labels, '') as labels,
    case when base.n > 0 then 1.0 else coalesce(best.score, 0.0) end::double as score
from d left join base using (r) left join every using (r) left join best using (r)
""".replace("PHRASES", ", ".join(f"('{p}', '{label}')" for p, label in licenses.PHRASES)).replace(
    "TEMPLATES",
    ", ".join(
        f"({i}, '{label}', '{b' '.join(licenses.words_of(text.encode())).decode()}')"
        for i, (label, text) in enumerate(licenses.TEMPLATES)
    ),
)

SQL = {
    "op2_quality_rules": QUALITY_RULES,
    "op7_exact_top_k": TOP_K,
    "op10_chat_formatting": CHAT,
    "op12_license_scans": LICENSES,
}
