"""DuckDB SQL with the rows of the registered queries, where SQL can express them."""

from __future__ import annotations

OP1 = """
with p as (
  select page_id, encode(coalesce(html, '')) as payload from pages
), d as (
  select page_id, octet_length(payload) as n, sha1(payload) as h from p
), b as (
  select page_id, n, list_aggregate(list_transform(range(8), lambda i:
    list_aggregate(list_transform([32768, 1024, 32, 1], lambda s:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * i, 5))::bigint // s) % 32)::int, 1)), 'string_agg', '')),
    'string_agg', '') as digest
  from d
), f as (
  select *, min(page_id) over (partition by digest, n) as head from b
)
select page_id, n::bigint as payload_bytes, digest as payload_digest,
  case when page_id = head then 'response' else 'revisit' end as record_type,
  case when page_id <> head then head end as refers_to
from f
"""

OP6 = """
with t as (
  select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as h
  from documents
)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
  doc_id = max(doc_id) over w as kept, h as text_sha256
from t window w as (partition by h)
"""

OP7 = r"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), e as (
  select doc_id, w, unnest(range(1, len(w) - 11)) as i from d
), g as (
  select doc_id, i, array_to_string(w[i:i + 12], ' ') as s from e
), f as (
  select doc_id, i, doc_id > min(doc_id) over (partition by s) as gone from g
), r as (
  select doc_id, list(distinct j) as gone
  from (select doc_id, unnest(range(i, i + 13)) as j from f where gone) group by doc_id
), k as (
  select d.doc_id, len(w)::bigint as n_words, coalesce(len(r.gone), 0)::bigint as n_removed,
    list_transform(list_filter(range(1, len(w) + 1), lambda j: not list_contains(coalesce(r.gone, []), j)), lambda j: w[j]) as kept
  from d left join r using (doc_id)
)
select doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) as kept_sha256 from k
"""

OP12 = r"""
with recursive k as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_transform(split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ascii(x)::bigint),
      lambda c, b: list_reduce(range(8), lambda r, i: xor(r >> 1, 3988292384 * (r & 1)), xor(c, b)), 4294967295::bigint), 4294967295) % 20 as kind
  from conversations
), d as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(case kind when 0 then [] when 3 then [1, 2] else [1] end) as copy
  from k
), f as (
  select *, left(role, 1) as i, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body,
    row_number() over (partition by conv_id, role, text order by turn nulls first, copy) > 1 as again,
    row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as n
  from d
), g as (
  select *, case when body = '' then 'b' when again then 'd' when right(body, 1) not in ('.', '!', '?') then 't' else '' end as fault,
    lag(i) over (partition by conv_id order by n) as before
  from f
), s as (
  select conv_id, count(*) as rows_n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated,
    count(*) filter (before is not null and before || i not in ('su', 'ua', 'au')) as illegal
  from g group by conv_id
), best(conv_id, n, p, q, u, a) as (
  -- cost, edits and repaired lines of what follows, by state: nothing yet, system, user, assistant
  select conv_id, rows_n, {'c': 0, 'w': '', 'r': []::varchar[]}, {'c': 6, 'w': 'II', 'r': ['user:', 'assistant:']},
    {'c': 3, 'w': 'I', 'r': ['assistant:']}, {'c': 0, 'w': '', 'r': []::varchar[]}
  from s
  union all
  select conv_id, n - 1,
    list_sort([p1, {'c': u2.c + 3, 'w': 'I' || u2.w, 'r': list_prepend('user:', u2.r)}])[1],
    list_sort([q1, {'c': u2.c + 3, 'w': 'I' || u2.w, 'r': list_prepend('user:', u2.r)}])[1],
    u2, a2
  from (
    select *,
      list_sort([u1, {'c': a1.c + 3, 'w': 'I' || a1.w, 'r': list_prepend('assistant:', a1.r)}])[1] as u2,
      list_sort([a1, {'c': u1.c + 3, 'w': 'I' || u1.w, 'r': list_prepend('user:', u1.r)}])[1] as a2
    from (
      select b.conv_id, b.n,
        list_sort([{'c': p.c + 4, 'w': 'D' || p.w, 'r': p.r},
          {'c': if(stays and i = 's', q.c + extra, 1e9::int), 'w': 'K' || q.w, 'r': list_prepend(line, q.r)},
          {'c': if(stays and i = 'u', u.c + extra, 1e9::int), 'w': 'K' || u.w, 'r': list_prepend(line, u.r)},
          {'c': if(stays, u.c + 3 + extra, 1e9::int), 'w': 'R' || u.w, 'r': list_prepend('user:' || text, u.r)}])[1] as p1,
        list_sort([{'c': q.c + 4, 'w': 'D' || q.w, 'r': q.r},
          {'c': if(stays and i = 'u', u.c + extra, 1e9::int), 'w': 'K' || u.w, 'r': list_prepend(line, u.r)},
          {'c': if(stays, u.c + 3 + extra, 1e9::int), 'w': 'R' || u.w, 'r': list_prepend('user:' || text, u.r)}])[1] as q1,
        list_sort([{'c': u.c + 4, 'w': 'D' || u.w, 'r': u.r},
          {'c': if(stays and i = 'a', a.c + extra, 1e9::int), 'w': 'K' || a.w, 'r': list_prepend(line, a.r)},
          {'c': if(stays, a.c + 3 + extra, 1e9::int), 'w': 'R' || a.w, 'r': list_prepend('assistant:' || text, a.r)}])[1] as u1,
        list_sort([{'c': a.c + 4, 'w': 'D' || a.w, 'r': a.r},
          {'c': if(stays and i = 'u', u.c + extra, 1e9::int), 'w': 'K' || u.w, 'r': list_prepend(line, u.r)},
          {'c': if(stays, u.c + 3 + extra, 1e9::int), 'w': 'R' || u.w, 'r': list_prepend('user:' || text, u.r)}])[1] as a1
      from best b join (
        select conv_id as id, n as at, text, role || ':' || text as line, i, fault not in ('b', 'd') as stays, if(fault = 't', 3, 0) as extra from g
      ) r on r.id is not distinct from b.conv_id and r.at = b.n
    )
  )
), done as (
  select conv_id, p from best where n = 0
), ids as (
  select distinct conv_id from conversations
)
select ids.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(p.c, 0)::bigint as cost,
  coalesce(p.w, '') as audit, sha256(coalesce(array_to_string(p.r, chr(10)), '')) as repaired_sha256
from ids left join s on s.conv_id is not distinct from ids.conv_id left join done on done.conv_id is not distinct from ids.conv_id
"""

OP13 = r"""
with t as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), b as (
  select doc_id, part, len(w) < 50 as a, 100 * len(list_distinct(w)) < 65 * len(w) as b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) as c, regexp_matches(text, '[#$%&*|]') as d,
    coalesce(doc_id > min(doc_id) over (partition by text), false) as e
  from t
), l as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels where doc_id is not null group by doc_id
), m as (
  select part, [a, b, c, d, e] as fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from b left join l using (doc_id) group by all
), f as (
  select i, substr('ABCDE', i, 1) as x from range(1, 6) r(i)
), o as (
  select [f1.i, f2.i, f3.i, f4.i, f5.i] as places, f1.x || f2.x || f3.x || f4.x || f5.x as filter_order
  from f f1, f f2, f f3, f f4, f f5 where len(list_distinct([f1.i, f2.i, f3.i, f4.i, f5.i])) = 5
), r as (
  select part, fails, n, good, toxic, filter_order, places,
    coalesce(list_position(list_transform(places, lambda p: fails[p]), true), 9) as gone
  from m, o
), g as (
  select part, filter_order, step::int as step, places[step] as filter,
    sum(n) filter (gone > step) as kept, sum(n) filter (gone = step) as removed,
    sum(n) filter (gone < step and fails[places[step]]) as redundant,
    sum(n) filter (fails[places[step]] and len(list_filter(fails, lambda y: y)) = 1) as unique_fails,
    sum(good) filter (gone = step) as good_lost, sum(toxic) filter (gone = step) as toxic_lost
  from r, range(1, 6) q(step) group by all
)
select part, filter_order, step, coalesce(kept, 0)::bigint as kept, coalesce(removed, 0)::bigint as removed,
  coalesce(redundant, 0)::bigint as redundant, coalesce(unique_fails, 0)::bigint as unique_fails,
  coalesce(good_lost, 0)::bigint as good_lost, coalesce(toxic_lost, 0)::bigint as toxic_lost,
  coalesce(sum(removed) over (partition by part, filter), 0)::bigint as shapley
from g
"""

ORACLES: dict[str, str] = {
    "op1_warc": OP1,
    "op6_exact_dedup": OP6,
    "op7_substring_dedup": OP7,
    "op12_conversation_repair": OP12,
    "op13_filter_audit": OP13,
}
