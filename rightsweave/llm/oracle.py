"""DuckDB SQL for the queries whose results SQL can express."""

from __future__ import annotations

OP2 = r"""
with tiles as (
  select doc_id, regexp_extract_all(text,
           '(?:[^\n.!?]+|[.!?]+[^ \t\n\v\f\r.!?])*[.!?]*[ \t\n\v\f\r]*') as t
  from documents where text is not null),
each as (select doc_id, generate_subscripts(t, 1) - 1 as unit, unnest(t) as x from tiles),
placed as (
  select *, sum(length(x)) over (partition by doc_id order by unit) as stop,
         trim(regexp_replace(lower(x), '[ \t\n\v\f\r]+', ' ', 'g'), ' ') as body
  from each),
units as (
  select doc_id, unit, stop - length(x) as start, stop, md5(body) as digest
  from placed where length(body) - length(replace(body, ' ', '')) >= 4),
ranked as (
  select *, count(*) over (partition by digest) as copies,
         row_number() over (partition by digest order by doc_id, unit) as nth,
         first_value(doc_id) over (partition by digest order by doc_id, unit) as kept_doc_id,
         first_value(unit) over (partition by digest order by doc_id, unit) as kept_unit
  from units)
select doc_id, unit::int as unit, start::int as start, stop::int as stop, digest, copies, kept_doc_id,
       kept_unit::int as kept_unit
from ranked where nth > 1
"""

OP3 = """
with parts as (
  select vec_id, generate_subscripts(embedding, 1) as i, floor(256 * unnest(embedding)::double)::bigint as x
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (
  select q.vec_id as query_id, c.vec_id, sum(q.x * c.x)::bigint as score
  from parts q join parts c on q.i = c.i and q.vec_id <> c.vec_id
  where q.vec_id % 50 = 0
  group by 1, 2),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scores)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

OP6 = """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) as (
  select vec_id, vec_id from embeddings
  union
  select r.a, l.b from reach r join links l on l.a = r.b),
least as (select a as vec_id, min(b) as component_id from reach group by 1),
n as (select a as vec_id, count(*) as n from links group by 1)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from least left join n using (vec_id)
"""

OP4 = r"""
with rows as (
  select conv_id, turn, role, text from conversations
  union all
  select * from (values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from rows),
marked as (
  select *, replace(replace(replace(text, '\', '\\'), '### ', '\### '), '</turn>', '\</turn>') as written from said)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(4 + length(role) + 2 + length(written) + 8)::bigint as formatted_chars
from marked group by conv_id
"""

OP11 = r"""
with bodies as (
  select doc_id, length(coalesce(text, '')) as n, regexp_replace(coalesce(text, ''), '[ \t\n\v\f\r]', '', 'g') as body from documents),
ranked as (
  select doc_id, body, row_number() over w as nth, first_value(doc_id) over w as keep_id,
         count(*) over (partition by body) as group_size
  from bodies window w as (partition by body order by n desc, doc_id))
select doc_id, keep_id, group_size, nth = 1 as kept, sha256(body) as text_sha256 from ranked
"""

OP12 = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, embedding from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (
  select vec_id, label, generate_subscripts(embedding, 1) as i, floor(256 * unnest(embedding)::double)::bigint as x from v),
scores as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, sum(a.x * c.x)::bigint as score
  from parts a join parts c on a.i = c.i and a.vec_id <> c.vec_id
  where a.vec_id % 100 = 0 group by 1, 2, 3),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score,
         row_number() over (partition by anchor_id order by score desc, vec_id) as nth
  from scores where same),
mined as (
  select p.anchor_id, positive_id, positive_score, s.vec_id as negative_id, s.score as negative_score,
         row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)::int as rank
  from positives p join scores s on s.anchor_id = p.anchor_id and not s.same
  where nth <= 5 and 80 * positive_score <= 100 * s.score and 100 * s.score <= 100 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from mined where rank <= 5
"""

ORACLE: dict[str, str] = {
    "op2_substrings": OP2,
    "op3_topk": OP3,
    "op4_chat": OP4,
    "op6_vectors": OP6,
    "op11_exact": OP11,
    "op12_negatives": OP12,
}
