"""DuckDB SQL for the rows of queries that SQL can express."""

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP4 = f"""
with d as (select doc_id, lang, source, coalesce(text, '') as text, trim(coalesce(text, ''), {_WHITE}) as trimmed from documents),
t as (select doc_id, unnest(words) as word, unnest(range(len(words))) as p
      from (select doc_id, regexp_split_to_array(trimmed, '[\\x20\\x09-\\x0D]+') as words from d where trimmed <> '')),
g as (select doc_id, p, word || ' ' || lead(word, 1) over x || ' ' || lead(word, 2) over x as g from t window x as (partition by doc_id order by p)),
r as (select doc_id, p from (select *, count(*) over (partition by doc_id, g) as m from g where g is not null) where m > 1),
c as (select doc_id, count(distinct p + o) as n from r cross join (values (0), (1), (2)) as v(o) group by doc_id),
n as (select doc_id, count(*) as n from t group by doc_id),
l as (select doc_id, count(*) as n, count(*) - count(distinct line) as dup
      from (select doc_id, unnest(string_split(text, chr(10))) as line from d) where trim(line, {_WHITE}) <> '' group by doc_id),
s as (select d.doc_id, lang, source, coalesce(n.n, 0) as n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) as word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as n_symbols, coalesce(l.n, 0) as n_lines, coalesce(l.dup, 0) as n_dup_lines,
             coalesce(c.n, 0) as n_repeat_words
      from d left join n using (doc_id) left join l using (doc_id) left join c using (doc_id)),
v as (select *, case when n_words > 0 then 1000 * word_chars // n_words end as word_length, case when n_words > 0 then 1000 * n_symbols // n_words end as symbols,
             case when n_lines > 0 then 1000 * n_dup_lines // n_lines end as dup_lines, case when n_words > 0 then 1000 * n_repeat_words // n_words end as repeats from s),
w as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from v),
u as (select lang, source, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) as rule, unnest([word_length, symbols, dup_lines, repeats]) as value from w where not base_failed),
b as (select *, (value >> greatest(length(bin(value)) - 7, 0)) << greatest(length(bin(value)) - 7, 0) as bucket from u where value is not null),
h as (select 2 as level, lang, source, rule, bucket, count(*) as n from b group by all
      union all select 1, lang, null, rule, bucket, count(*) from b group by all
      union all select 0, null, null, rule, bucket, count(*) from b group by all),
k as (select *, sum(n) over (partition by level, lang, source, rule order by bucket) as upto, sum(n) over (partition by level, lang, source, rule) as total from h),
q as (select level, lang, source, rule, max(total)::double as total, min(case when 4 * upto >= total then bucket end) as q1, min(case when 4 * upto >= 3 * total then bucket end) as q3
      from k group by all),
e as (select level, lang, source, rule, total * total / (total * total + 2500.0::double) as share, 2500.0::double / (total * total) as unsure, q1::double as q1, q3::double as q3,
             (q3 + (1 << greatest(length(bin(q3)) - 7, 0)) - 1)::double as top from q),
m as (select a.lang, a.source, a.rule, z.unsure, a.share * a.q1 + (1.0::double - a.share) * (m.share * m.q1 + (1.0::double - m.share) * z.q1) as q1,
             a.share * a.q3 + (1.0::double - a.share) * (m.share * m.q3 + (1.0::double - m.share) * z.q3) as q3,
             a.share * a.top + (1.0::double - a.share) * (m.share * m.top + (1.0::double - m.share) * z.top) as top
      from (select * from e where level = 2) a join (select * from e where level = 1) m on a.lang is not distinct from m.lang and a.rule = m.rule
      join (select * from e where level = 0) z on a.rule = z.rule),
p as (select lang, source, rule, cast(floor(top + 4.0::double * (q3 - q1) + q3 * unsure) as bigint) as high, cast(floor(q1 - 4.0::double * (q3 - q1) - q1 * unsure) as bigint) as low from m),
o as (select lang, source, max(case when rule = 'word_length' then high end) as word_length_high, max(case when rule = 'word_length' then low end) as word_length_low,
             max(case when rule = 'symbols' then high end) as symbols_high, max(case when rule = 'dup_lines' then high end) as dup_lines_high,
             max(case when rule = 'repeats' then high end) as repeats_high
      from p group by lang, source),
f as (select w.*, coalesce(1000 * word_chars > (word_length_high + 100) * n_words + 30000, false) or coalesce(1000 * word_chars < (word_length_low - 100) * n_words - 30000, false)
             or coalesce(1000 * n_symbols > (symbols_high + 10) * n_words + 3000, false) or coalesce(1000 * n_dup_lines > (dup_lines_high + 50) * n_lines + 3000, false)
             or coalesce(1000 * n_repeat_words > (repeats_high + 60) * n_words + 30000, false) as bad
      from w left join o on w.lang is not distinct from o.lang and w.source is not distinct from o.source)
select doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed, not (base_failed or bad) as kept from f"""

OP7 = """
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, cast(octet_length(encode(html)) as bigint) as payload_bytes, sha1(html) as payload_digest,
             max(page_id) over (partition by html) as last from p)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id < last then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id < last then last end as refers_to
from d"""

OP9 = f"""
with recursive d as (select doc_id, trim(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WHITE}) as t from documents),
l as (select doc_id, regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+') as w from d where t <> ''),
u as (select doc_id, w, unnest(range(greatest(len(w) - 3, 1))) as i from l),
s as (select distinct doc_id, array_to_string(w[i + 1:i + 4], ' ') || case when len(w) < 4 then chr(9) || len(w) else '' end as s from u),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b using (s) where a.doc_id <> b.doc_id group by all),
e as (select a, b, shared = x.n and shared = y.n as same from p join n x on a = x.doc_id join n y on b = y.doc_id where 100 * shared >= 80 * (x.n + y.n - shared)),
r(a, b) as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
c as (select a, min(b) as m from r group by a),
k as (select a, min(b) as m from e where same group by a)
select d.doc_id, coalesce(n.n, 0) as n_shingles, least(d.doc_id, coalesce(c.m, d.doc_id)) as component_id,
       d.doc_id <= coalesce(c.m, d.doc_id) as kept, least(d.doc_id, coalesce(k.m, d.doc_id)) as class_id
from d left join n using (doc_id) left join c on c.a = d.doc_id left join k on k.a = d.doc_id"""

OP11 = f"""
with t as (select doc_id, trim(coalesce(text, ''), {_WHITE}) as t from documents),
d as (select doc_id, case when t = '' then [] else regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+') end as w from t),
g as (select doc_id, i, array_to_string(w[i + 1:i + 20], ' ') as g from (select doc_id, w, unnest(range(len(w) - 19)) as i from d)),
m as (select doc_id, i, rank() over (partition by g order by doc_id, i) > 1 as later from g),
c as (select distinct doc_id, i + o as p from m cross join (select unnest(range(20)) as o) where later),
x as (select d.doc_id, u.p, u.word from d, lateral (select unnest(w) as word, unnest(range(len(w))) as p) u),
k as (select doc_id, count(c.p) as n_removed, string_agg(x.word, ' ' order by x.p) filter (c.p is null) as kept from x left join c using (doc_id, p) group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join k using (doc_id)"""

OP13 = """
with t as (select coalesce(lang, 'und') as lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) as p from t),
w as (select lang, list_filter(regexp_split_to_array(p, '[\\x20\\x09]+'), lambda x: x <> '') as w from p),
s as (select lang, w, unnest([1, 2, 3, 4]) as m from w),
g as (select lang, m, w[i + 1:i + m] as g from (select lang, w, m, unnest(range(len(w) - m + 1)) as i from s)),
f as (select lang, m, g, count(*) as f from g group by all),
n as (select lang, sum(f) as n from f where m = 1 group by lang),
c as (select lang, m, g, f as a from f where m > 1 and f >= 30),
k as (select c.*, unnest(range(1, m)) as k from c),
x as (select k.lang, k.g, k.m, k.a, k.k, l.f as l, r.f as r, 2000000::hugeint * k.a // (l.f + r.f) as score
      from k join f l on l.lang = k.lang and l.g = k.g[1:k.k] join f r on r.lang = k.lang and r.g = k.g[k.k + 1:]),
b as (select lang, g, m, a, l, r, score from x qualify row_number() over (partition by lang, g order by score, k) = 1),
z as (select lang, m, a, unnest(range(m)) as i, g from c where m > 2),
y as (select distinct lang, g[i + 1:j] as g, a from (select *, unnest(range(i + 2, m + 1)) as j from z) where j - i < m),
o as (select b.* from b where not exists (select 1 from y where y.lang = b.lang and y.g = b.g and 100::hugeint * y.a >= 80 * b.a)),
q as (select lang, array_to_string(g, ' ') as phrase, a, l, r, score from o),
v as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from q)
select lang, cast(rank as bigint) as rank, phrase, cast(a as bigint) as a, cast(l as bigint) as l, cast(r as bigint) as r, cast(n as bigint) as n, cast(score as bigint) as score
from v join n using (lang) where rank <= 2000"""
