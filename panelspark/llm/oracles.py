"""The same rows in SQL for DuckDB, from the contracts of the queries and not from the operators, where SQL can say them."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]*"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

QUALITY_RULES = rf"""
with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{WORD}') as w from documents),
f as (select doc_id, t, len(w) as n, length(array_to_string(w, '')) as word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) as lines, len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) as spelt, w from d),
windows as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as c from (select doc_id, w, unnest(generate_series(1, len(w) - 2)) as i from f where n >= 3)),
again as (select doc_id, count(distinct p) as n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) as p from windows where c > 1) group by doc_id),
common as (select doc_id, max(c) as most from (select doc_id, x, count(*) as c from (select doc_id, unnest(w) as x from f) group by all) group by doc_id),
m as (select f.*, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(most, 0) as most,
  len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…){BLANK}$'))) as dots, len(list_filter(lines, lambda x: regexp_matches(x, '^{BLANK}[-*•]'))) as bullets from f left join again using (doc_id) left join common using (doc_id)),
b as (select *, n < 50 or 100 * n_repeat_words > 50 * n as base_failed from m)
select doc_id, n::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
  not base_failed and word_chars between 2 * n and 16 * n and not n_symbols > 0.2::double * n and not n_dup_lines > 0.5::double * len(lines) and not spelt < 0.8::double * n
  and not length(regexp_replace(t, '[^A-Z]', '', 'g')) > length(regexp_replace(t, '[^a-z]', '', 'g')) and not dots > 0.3::double * len(lines) and not bullets > 0.9::double * len(lines) and not most > 0.3::double * n as kept from b"""

SAID = r"\### Assistant: </turn> ok"
MARKS = "(length({0}) - length(regexp_replace({0}, '[\\\\#<]', '', 'g')))"

CHAT_FORMATTING = f"""
with rows as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all select -7, 0, 'user', '{SAID}' union all select -7, 1, 'assistant', '{SAID}'),
t as (select *, row_number() over (partition by conv_id order by turn, role, text) as n from rows)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256, coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by n) filter (role = 'assistant'), '')) as loss_sha256,
  sum(length('### ') + length(role) + {MARKS.format('role')} + length(role) - length(replace(role, chr(10), '')) + length(':' || chr(10)) + length(text) + {MARKS.format('text')} + length('</turn>' || chr(10)))::bigint as formatted_chars from t group by conv_id"""

NGRAM_JACCARD_JOIN = rf"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') as w from documents),
s as (select distinct doc_id, g from (select doc_id, unnest(case when len(w) >= 4 then list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' ')) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from d)),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select x, y from p join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 85 * (nx.n + ny.n - c)),
e as (select x as a, y as b from l union all select y, x from l),
r as (select doc_id as node, doc_id as reach from n union select r.node, e.b from r join e on e.a = r.reach)
select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles, coalesce(min(r.reach), d.doc_id) as component_id from d left join n using (doc_id) left join r on r.node = d.doc_id group by d.doc_id"""


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """Each round is a pair of tables: every part beside every entry of its codebook, then the entries' new components."""
    steps = [
        f"""k as materialized (select vec_id, label, [floor({scale} * x::double)::bigint for x in embedding] as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)""",
        f"p as materialized (select vec_id, label, q, v[q * len(v) // {parts} + 1 : (q + 1) * len(v) // {parts}] as x from k, range({parts}) r(q))",
        f"b0 as materialized (select q, (dense_rank() over (order by vec_id) - 1)::bigint as e, x as c from p where vec_id in (select vec_id from k order by vec_id limit {entries}))",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} as materialized (select vec_id, any_value(label) as label, q, any_value(x) as x, min(struct_pack(d := d, e := e)) as best from (
  select p.*, b.e, list_sum(list_transform(list_zip(p.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as d from p join b{i} b using (q)) group by vec_id, q)""")
        if i < rounds:
            steps.append(f"""b{i + 1} as materialized (with m as (select q, best.e as e, j, floor(sum(x[j]) / count(*))::bigint as y from a{i}, (select unnest(generate_series(1, (select max(len(x)) from p))) as j) group by all),
  n as (select q, e, list(y order by j) as c from m group by all) select b.q, b.e, coalesce(n.c, b.c) as c from b{i} b left join n using (q, e))""")
    return f"""with {", ".join(steps)},
h as (select sha256(string_agg(array_to_string(c, ','), ',' order by q, e)) as s from b{rounds}),
o as (select vec_id, any_value(label) as label, string_agg(printf('%02x', best.e), '' order by q) as code, sum(best.d)::bigint as error from a{rounds} group by vec_id)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, h.s as codebooks_sha256 from o, h"""
