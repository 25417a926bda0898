"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from . import chat


def _escaped(column: str) -> str:
    out = f"replace(coalesce({column}, ''), '\\', '\\\\')"
    for control in chat.CONTROL_STRINGS:
        out = f"replace({out}, '{control}', '{control[0]}\\{control[1:]}')"
    return out


OP5 = f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked as (
  select *, coalesce(lag(role) over (partition by conv_id order by turn, role, text) <> role, true) as opens from rows
)
select conv_id,
  count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = '{chat.LOSS_ROLE}'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = '{chat.LOSS_ROLE}'), '')) as loss_sha256,
  cast(sum(length({_escaped('text')}) + case when opens then length({_escaped('role')})
    + {len(chat.START + chat.SEP + chat.END)} else {len(chat.PART)} end) as bigint) as formatted_chars
from marked group by conv_id
"""

OP8 = """
with t as (select doc_id, coalesce(text, '') as text from documents),
g as (select text, max(doc_id) as keep_id, count(*) as group_size from t group by text)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(text) as text_sha256
from t join g using (text)
"""

# Eight groups of five hex digits are 20 bits each, that is four base32 letters.
OP6 = """
with p as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as sha from pages),
g as (select body, count(*) as copies, max(page_id) as response_id from p group by body)
select page_id,
  cast(octet_length(encode(body)) as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((cast('0x' || substr(sha, 1 + 5 * (k // 4), 5) as bigint) >> (15 - 5 * (k % 4))) & 31), 1)), '') as payload_digest,
  case when copies > 1 and page_id is distinct from response_id and response_id is not null
    then 'revisit' else 'response' end as record_type,
  case when copies > 1 and page_id is distinct from response_id then response_id end as refers_to
from p join g using (body)
"""

OP10 = r"""
with recursive w as (
  select doc_id, regexp_extract_all(lower_az, '[^\x20\x09-\x0D]+') as words
  from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_az from documents)
), s as (
  select doc_id, case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
    else list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' '))) end as shingles,
    len(words) < 5 as short from w
), t as (
  select doc_id, short, len(shingles) as n, unnest(shingles) as token from s
), links as (
  select a.doc_id as x, b.doc_id as y from t a join t b on a.token = b.token and a.short = b.short
  where a.doc_id <> b.doc_id group by 1, 2, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach as (
  select doc_id, doc_id as other from s union select reach.doc_id, links.y from reach join links on links.x = reach.other
)
select s.doc_id, cast(len(shingles) as bigint) as n_shingles, (select min(other) from reach r where r.doc_id = s.doc_id) as component_id
from s
"""

_NUMBER = "cast('0x' || substr(md5({0}), 1, 4) as bigint)"
_DAY = "timestamp '2024-01-01' + to_seconds(({0}) * 86400)"

OP3 = rf"""
with parts as (
  select page_id, url, timestamp '2024-01-01' + to_seconds((page_id * 7919) % 63072000) as ts,
    regexp_extract(lower(url), '^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1) as host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) as path,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) as rest
  from pages
), spam as (select host as key, {_NUMBER.format('host')} as x from (select distinct host from parts where host <> '')),
parents as (select key, {_NUMBER.format('key')} as x
  from (select distinct array_to_string(string_split(host, '.')[-2:], '.') as key from parts where host <> '')),
partners as (select key, {_NUMBER.format('key')} as x from (select distinct host || '/' || string_split(path, '/')[2] as key
  from parts where path like '/_%' and string_split(path, '/')[2] <> '')),
wholes as (select key, {_NUMBER.format('key')} as x from (select distinct host || rest as key from parts where host || rest <> '')),
changes as (
  select 'spam' as list, false as allows, 'domain' as kind, key, {_DAY.format('x % 700')} as ts, true as listed from spam where x % 5 < 2
  union all select 'spam', false, 'domain', key, {_DAY.format('x % 700 + 30 + x % 97')}, false from spam where x % 5 < 2
  union all select 'spam', false, 'domain', key, {_DAY.format('x % 700 + 200')}, true from spam where x % 5 < 2 and x % 3 = 0
  union all select 'malware', false, 'domain', key, {_DAY.format('x % 500')}, true from parents
  union all select 'malware', false, 'domain', key, {_DAY.format('x % 500 + 60')}, false from parents
  union all select 'partners', true, 'prefix', key, {_DAY.format('x % 300')}, true from partners where x % 7 = 0
  union all select 'malware', false, 'url', key, {_DAY.format('x % 400')}, true from wholes where x % 50 = 0
), states as (select list, allows, kind, key, ts, max(listed) as listed from changes group by all),
intervals as (select *, lead(ts) over (partition by list, allows, kind, key order by ts) as until from states),
labels as (select page_id, ts, host, rest, string_split(host, '.') as l,
  list_filter(string_split(path, '/'), lambda s: s <> '') as p from parts where host <> ''),
keys as (
  select page_id, ts, 0 as level, 'domain' as kind, array_to_string(l[i:], '.') as key from labels, unnest(range(1, len(l) + 1)) as u(i)
  union all select page_id, ts, 1, 'prefix', host || '/' || array_to_string(p[1:i], '/') from labels, unnest(range(1, len(p) + 1)) as u(i)
  union all select page_id, ts, 2, 'url', host || rest from labels
), matches as (
  select page_id, level, length(key) as chars, allows, list, kind, key,
    row_number() over (partition by page_id order by level desc, length(key) desc, allows desc, list desc, kind desc, key desc) as nth,
    count(*) over (partition by page_id) as n_matches
  from keys join intervals using (kind, key)
  where listed and intervals.ts <= keys.ts and (until is null or keys.ts < until)
)
select page_id, parts.ts as fetched_at, coalesce(not allows, false) as blocked, coalesce(n_matches, 0) as n_matches,
  coalesce(list || ' ' || kind || ' ' || key, '') as decided_by
from parts left join (select * from matches where nth = 1) m using (page_id)
"""

OP12 = r"""
with d as (
  select row_number() over () as rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), i as (
  select row_number() over () as iid, item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from benchmark
), s as (select count(*) as big_n, cast(sum(len(terms)) as bigint) as big_l from d where len(terms) > 0),
tf as (select rid, term, count(*) as tf from (select rid, unnest(terms) as term from d) group by all),
w as (select term, cast(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) as bigint) as w from tf, s group by term, big_n),
impact as (select rid, doc_id, term, (1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * len(terms) * big_n) // big_l)) as impact
  from tf join d using (rid), s),
q as (select distinct iid, item_id, term from (select iid, item_id, unnest(terms) as term from i)),
scored as (select iid, item_id, rid, doc_id, cast(sum(w * impact) as bigint) as score
  from q join w using (term) join impact using (term) group by all having sum(w * impact) > 0)
select item_id, cast(rank as int) as rank, doc_id, score from (
  select *, row_number() over (partition by iid order by score desc, doc_id nulls last) as rank from scored) where rank <= 50
"""

OP13 = r"""
with w as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents)
), grams as (
  select lang, m, unnest(list_transform(range(1, len(words) - m + 2), lambda i: array_to_string(words[i:i + m - 1], ' '))) as phrase
  from w, (values (1), (2), (3), (4)) as sizes(m)
), f as (select lang, m, phrase, count(*) as f from grams group by all having count(*) >= 30),
total as (select lang, count(*) as n from grams where m = 1 group by lang),
cuts as (
  select lang, m, phrase, f as a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') as left_part,
    array_to_string(string_split(phrase, ' ')[k + 1:], ' ') as right_part
  from f, (values (1), (2), (3)) as places(k) where m >= 2 and k < m
), scored as (
  select c.lang, c.m, c.phrase, a, x.f as l, y.f as r, k, cast(cast(2000000 as hugeint) * a // (x.f + y.f) as bigint) as score
  from cuts c join f x on x.lang = c.lang and x.phrase = left_part join f y on y.lang = c.lang and y.phrase = right_part
), best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
inside as (
  select lang, array_to_string(string_split(phrase, ' ')[i:i + s - 1], ' ') as phrase, max(f) as longer
  from f, (values (1), (2), (3)) as places(i), (values (2), (3)) as sizes(s) where m >= 3 and s < m and i + s - 1 <= m group by all
)
select b.lang, row_number() over (partition by b.lang order by score desc, a desc, b.phrase) as rank, b.phrase, a, l, r, n, score
from best b join total using (lang) left join inside i on i.lang = b.lang and i.phrase = b.phrase
where longer is null or 100 * longer < 80 * a
qualify row_number() over (partition by b.lang order by score desc, a desc, b.phrase) <= 2000
"""
