"""DuckDB statements that give the rows of queries which SQL can express."""

from __future__ import annotations

import string

_WORD = r"[^\x20\x09-\x0D]+"

OP4 = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select r, regexp_extract_all(t, '{_WORD}') as ws from d),
windows as (select r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as v from (select r, ws, unnest(range(1, len(ws) - 1)) as i from w) u),
again as (select r, i from (select r, i, count(*) over (partition by r, v) as n from windows) c where n > 1),
covered as (select r, count(distinct i + k) as n from again, range(0, 3) x(k) group by r),
counted as (
  select d.doc_id, cast(len(w.ws) as bigint) as n_words, cast(length(array_to_string(w.ws, '')) as bigint) as word_chars,
         cast(length(d.t) - length(translate(d.t, '#*$%&|<>', '')) as bigint) as n_symbols,
         cast(len(list_filter(string_split(d.t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')))
              - len(list_distinct(list_filter(string_split(d.t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')))) as bigint) as n_dup_lines,
         cast(coalesce(c.n, 0) as bigint) as n_repeat_words, len(string_split(d.t, chr(10))) as n_lines,
         length(d.t) - length(translate(d.t, '{string.ascii_uppercase}', '')) as n_capitals
  from d join w on w.r = d.r left join covered c on c.r = d.r)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words or 10 * n_symbols > 5 * n_words
            or 100 * n_dup_lines > 30 * n_lines or word_chars < 2 * n_words or word_chars > 20 * n_words
            or 100 * n_capitals > 50 * word_chars) as kept
from counted
"""

OP5 = rf"""
with recursive d as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{_WORD}') as ws
  from documents),
shingles as (
  select distinct r, case when len(ws) < 5 then array_to_string(ws, ' ')
                          else array_to_string(ws[i:i + 4], ' ') end as s
  from (select r, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from d where len(ws) > 0) u),
size as (select r, count(*) as n from shingles group by r),
shared as (select a.r as x, b.r as y, count(*) as k from shingles a join shingles b on a.s = b.s and a.r <> b.r group by a.r, b.r),
links as (select x, y from shared join size p on p.r = x join size q on q.r = y where 100 * k >= 80 * (p.n + q.n - k)),
reach(r, way) as (select r, r from d union select reach.r, links.y from reach join links on links.x = reach.way)
select d.doc_id, cast(coalesce(size.n, 0) as bigint) as n_shingles, c.component_id
from d left join size on size.r = d.r
     join (select reach.r, min(o.doc_id) as component_id from reach join d o on o.r = reach.way group by reach.r) c on c.r = d.r
"""


def _vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Product codes with every distance evaluated, one step a round."""
    steps = [f"""
kept as materialized (
  select row_number() over (order by vec_id) as r, vec_id, label, embedding from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
x as materialized (
  select r, (k * {parts}) // n as p, k, cast(floor(4096 * cast(embedding[k + 1] as double)) as bigint) as v
  from (select r, embedding, len(embedding) as n, unnest(range(0, len(embedding))) as k from kept) u),
b0 as materialized (select p, r - 1 as e, k, v from x where r <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
d{i} as (select x.r, x.p, b.e, cast(sum((x.v - b.v) * (x.v - b.v)) as bigint) as d from x join b{i} b on b.k = x.k group by x.r, x.p, b.e),
a{i} as materialized (select r, p, min(d * {entries} + e) % {entries} as e, min(d) as d from d{i} group by r, p)""")
        if i < rounds:
            steps.append(f"""
m{i} as (select x.p, a.e, x.k, cast(sum(x.v) as bigint) as s, count(*) as n from x join a{i} a on a.r = x.r and a.p = x.p group by x.p, a.e, x.k),
b{i + 1} as materialized (
  select b.p, b.e, b.k, coalesce((s - ((s % n) + n) % n) // n, b.v) as v
  from b{i} b left join m{i} m on m.e = b.e and m.k = b.k)""")
    last = f"a{rounds}"
    return f"""with {",".join(steps)},
coded as (select r, string_agg(format('{{:02x}}', e), '' order by p) as code, cast(sum(d) as bigint) as error from {last} group by r)
select kept.vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(cast(v as varchar), ',' order by p, e, k)) from b{rounds}) as codebooks_sha256
from coded join kept on kept.r = coded.r
"""


OP11 = _vector_codes_sql()

OP13 = rf"""
with d as (
  select doc_id, row_number() over () as r,
         regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ts
  from documents),
size as materialized (select r, doc_id, len(ts) as n from d where len(ts) > 0),
total as (select count(*) as docs, cast(sum(n) as bigint) as terms from size),
q as materialized (
  select i, item_id, t, count(*) as times
  from (select i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t
        from (select item_id, text, row_number() over () as i from benchmark) b) u
  group by i, item_id, t),
tf as materialized (
  select r, t, count(*) as tf from (select r, unnest(ts) as t from d) u where t in (select t from q) group by r, t),
w as (select t, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / cast(2 * df + 1 as double))) as bigint) as w
      from (select t, count(*) as df from tf group by t) f, total),
part as (
  select tf.r, tf.t, w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * size.n * docs) // terms))) as part
  from tf join size on size.r = tf.r join w on w.t = tf.t, total),
scored as (select q.i, q.item_id, part.r, cast(sum(q.times * part.part) as bigint) as score from q join part on part.t = q.t group by q.i, q.item_id, part.r),
ranked as (
  select item_id, row_number() over (partition by i order by score desc, doc_id, s.r) as rank, doc_id, score
  from scored s join size on size.r = s.r where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 10
"""
