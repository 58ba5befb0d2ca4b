"""DuckDB SQL for the operators that SQL can express, written from their contracts."""

from __future__ import annotations

from tierstone.llm import licences

CHAT_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked as (
  select *, lag(role) over w as before, lead(role) over w as after,
         length(replace(text, '\', '\e'))
           + len(regexp_extract_all(text, '<\|')) + len(regexp_extract_all(text, '</?s>')) + len(regexp_extract_all(text, '</?SYS>>'))
           + len(regexp_extract_all(text, '<</?SYS>>')) + len(regexp_extract_all(text, '\[/?INST\]')) as escaped
  from turns window w as (partition by conv_id order by turn, role, text)
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(escaped + case when before = role then 8 else length(role) + 4 end + case when after = role then 0 else 7 end)::bigint as formatted_chars
from marked group by conv_id
"""

CONTAMINATION_SQL = r"""
with item_words as (
  select item_id::varchar as item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
  from benchmark
), item_windows as (
  select distinct item_id, least(len(ws), 10) as n, array_to_string(ws[i : i + 9], ' ') as win
  from item_words, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as r(i) where len(ws) > 0
), doc_words as (
  select doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as ws
  from documents
), lengths as (select distinct n from item_windows
), doc_windows as (
  select doc_id, i, n, array_to_string(ws[i : i + n - 1], ' ') as win
  from doc_words, lengths, unnest(range(1, len(ws) - n + 2)) as r(i)
), matched as (select doc_id, i, n, item_id from doc_windows join item_windows using (n, win)
), hits as (
  select doc_id, count(distinct p) as n_hit from matched, unnest(range(i, i + n)) as r(p) group by doc_id
), items as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
  from (select distinct doc_id, item_id from matched) group by doc_id
), near_windows as (
  select win, n, ceil(0.8 * n)::int as need, string_split(win, ' ') as w from (select distinct win, n from item_windows)
), near_parts as (
  select win, n, need, off, w[off + 1] as term, w[off + 2] as next from near_windows, unnest(range(0, n)) as r(off)
), doc_tokens as (
  select doc_id, p, ws[p + 1] as term, ws[p + 2] as next from doc_words, unnest(range(0, len(ws))) as r(p)
), near_pairs as (
  select doc_id, win, any_value(n) as n, any_value(need) as need, p - off + e as start
  from near_parts join doc_tokens using (term, next), unnest([-1, 0, 1]) as r(e)
  group by doc_id, win, p - off + e having count(distinct off) >= any_value(greatest(1, n - 1 - 2 * (n - need)))
  union all select doc_id, win, n, need, p from near_parts join doc_tokens using (term) where n = 1
), near_places as (
  select doc_id, win from near_pairs join near_parts using (win, n, need) join doc_tokens using (doc_id, term)
  where abs(p - off - start) <= case when n = 1 then 0 else 1 end
  group by doc_id, win, start having count(distinct off) >= any_value(need)
), near_items as (
  select doc_id, count(*) as n_near, string_agg(item_id, ',' order by item_id) as near_ids
  from (select distinct doc_id, item_id from near_places join item_windows using (win)) group by doc_id
)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated,
       coalesce(n_near, 0)::bigint as n_near_items, sha256(coalesce(near_ids, '')) as near_items_sha256
from doc_words left join hits using (doc_id) left join items using (doc_id) left join near_items using (doc_id)
"""

RANKED_SQL = r"""
with doc_terms as (
  select row_number() over () as d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
), lengths as (select d, count(*) as n from doc_terms group by d
), totals as (select count(*)::bigint as docs, sum(n)::bigint as length from lengths
), counts as (select d, doc_id, term, count(*) as tf from doc_terms group by all
), items as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark
), weights as (
  select term, floor(1000 * ln((2 * any_value(docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from counts, totals group by term
), scores as (
  select item_id, d, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::bigint as score
  from items join weights using (term) join counts using (term) join lengths using (d), totals group by all
), ranks as (select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as rank from scores where score > 0)
select item_id, rank::integer as rank, doc_id, score from ranks where rank <= 50
"""

REPEATED_SQL = r"""
with words as (
  select row_number() over () as d, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) as ws from documents
), windows as (
  select d, i, hash(ws[i : i + 34]) as h, array_to_string(ws[i : i + 34], ' ') as win
  from words, unnest(range(1, len(ws) - 33)) as r(i)
), twice as (select h, win from windows group by h, win having count(*) > 1
), gone as (
  select distinct d, p from windows join twice using (h, win), unnest(range(i, i + 35)) as r(p)
), kept as (
  select d, string_agg(w, ' ' order by p) as text, count(*) as n
  from (select d, unnest(ws) as w, unnest(range(1, len(ws) + 1)) as p from words) left join (select d, p, true as hit from gone) using (d, p)
  where hit is null group by d
)
select doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(text, '')) as kept_sha256
from words left join kept using (d)
"""


def licence_sql(ids: int) -> str:
    vectors, unknown = licences.template_vectors()
    template_rows = ", ".join(f"('{t}', '{w}', {v!r})" for t, w, v in vectors)
    idf_rows = ", ".join(f"('{w}', {v!r})" for w, v in licences.word_weights())
    words = "regexp_split_to_array(lower({}), '[^0-9a-z]+')"
    return f"""
with template(template, word, weight) as (values {template_rows}),
idfs(word, idf) as (values {idf_rows}),
files as (
  select doc_id, concat_ws('/', source, lang, (doc_id // {ids})::varchar, doc_id::varchar) as path,
         regexp_replace(concat_ws('/', source, lang, (doc_id // {ids})::varchar, doc_id::varchar), '/?[^/]*$', '') as directory,
         len(list_filter({words.format("text")}, lambda w: w <> '')) as n_words,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{licences.TRIGGER}')) as lines
  from documents
), lines as (select doc_id, i as line, lines[i] as content from files, unnest(range(1, len(lines) + 1)) as r(i)
), bags as (
  select doc_id, line, word, count(*) as tf, count(*) * coalesce(any_value(idf), {unknown!r}) as w
  from (select doc_id, line, unnest({words.format("content")}) as word from lines) left join idfs using (word)
  where word <> '' group by all
), norms as (select doc_id, line, sqrt(sum(w * w)) as norm, sum(tf) as line_words from bags group by all
), cosines as (
  select doc_id, line, template, round(sum(w * weight) / any_value(norm), 6) as cosine, any_value(line_words) as line_words
  from bags join template using (word) join norms using (doc_id, line) group by all
), best as (
  select doc_id, line, string_split(template, '|')[2] as licence, cosine as score, line_words from cosines
  qualify row_number() over (partition by doc_id, line order by cosine desc, template) = 1
), own as (
  select doc_id, sum(line_words) as notice_words, first(licence order by score desc, licence) as own, max(score) as own_score
  from best where score >= {licences.THRESHOLD} group by doc_id
), declared as (
  select directory as above, first(own order by own_score desc, own) as licence, max(own_score) as score
  from files join own using (doc_id) where notice_words >= {licences.NOTICE_SHARE} * n_words group by directory
), up as (
  select directory, d as depth, array_to_string(string_split(directory, '/')[1 : d], '/') as above
  from (select distinct directory from files), unnest(range(0, len(string_split(directory, '/')) + 1)) as r(d)
), nearest as (
  select directory, above, licence as from_above, score as score_above from up join declared using (above)
  qualify row_number() over (partition by directory order by depth desc) = 1
)
select doc_id, path, coalesce(own, from_above) as licence, coalesce(own_score, score_above) as score,
       case when own is not null then 'own' when from_above is not null then 'inherited' end as found,
       case when own is null then above end as licence_dir
from files left join own using (doc_id) left join nearest using (directory)
"""
