"""DuckDB SQL with the same rows as the queries, where SQL can say it."""

from __future__ import annotations

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

ORACLES: dict[str, str] = {}

ORACLES["op1_sharding"] = """
with recursive
bits(i, k, c) as (
  select i, 0, i::ubigint from range(256) r(i)
  union all
  select i, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end from bits where k < 8
),
steps as (select list(c order by i) as t from bits where k = 8),
rows as (select doc_id, coalesce(text, '') as text, octet_length(encode(coalesce(text, ''))) as n from documents),
checked as (
  select doc_id, n + 8 as size, case when n = 0 then 0 else xor(list_reduce(
      list_prepend(4294967295::ubigint, list_transform(range(n), lambda i: ('0x' || substr(hex(encode(text)), 2 * i + 1, 2))::ubigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::bigint + 1])), 4294967295::ubigint) end as crc
  from rows, steps
),
placed as (
  select *, sum(size) over (order by doc_id nulls first, size, crc rows unbounded preceding) - size as ahead, sum(size) over () as total
  from checked
),
cut as (select *, ((2 * ahead + size) * 24 // (2 * total))::int as shard from placed)
select doc_id, size::bigint as size, crc::bigint as text_crc32, 'bytes' as law, shard,
  row_number() over (partition by shard order by ahead, doc_id) - 1 as slot, null::int as grown_shard
from cut
"""

ORACLES["op2_jaccard"] = f"""
with recursive
words as (
  select doc_id, {WORDS.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents
),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) end as s
  from words
),
items as (select doc_id, unnest(s) as item from sets),
meets as (select a.doc_id as x, b.doc_id as y, count(*) as shared from items a join items b on a.item = b.item and a.doc_id <> b.doc_id group by all),
links as (
  select x, y from meets join sets a on a.doc_id = x join sets b on b.doc_id = y
  where 100 * shared >= 85 * (len(a.s) + len(b.s) - shared)
),
reach(doc_id, other) as (select doc_id, doc_id from sets union select reach.doc_id, y from reach join links on x = other)
select doc_id, len(any_value(s))::bigint as n_shingles, min(other) as component_id from reach join sets using (doc_id) group by doc_id
"""

ORACLES["op3_substrings"] = f"""
with
words as (select doc_id, {WORDS.format("coalesce(text, '')")} as w from documents),
windows as (
  select doc_id, unnest(range(1, len(w) - 11)) as i, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) as s from words
),
judged as (select doc_id, i, min(doc_id) over (partition by s) < doc_id as again from windows),
gone as (select doc_id, list_distinct(flatten(list(range(i, i + 13)))) as g from judged where again group by doc_id),
kept as (
  select doc_id, len(w) as n, coalesce(len(g), 0) as r,
    case when g is null then w else list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: not list_contains(g, x[2])), lambda x: x[1]) end as k
  from words left join gone using (doc_id)
)
select doc_id, n::bigint as n_words, r::bigint as n_removed, sha256(array_to_string(k, ' ')) as kept_sha256 from kept
"""

ORACLES["op4_warc"] = """
with told as (select page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as d from pages),
large as (select *, case when n >= 1000 then max(page_id) over (partition by d, n) end as top from told)
select page_id, n::bigint as payload_bytes, d as payload_digest,
  case when page_id < top then 'revisit' else 'response' end as record_type, case when page_id < top then top end as refers_to
from large
"""

ORACLES["op6_topk"] = """
with usable as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as v from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda x: x[1] * x[2]))::bigint as score
  from usable q join usable c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v)
),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 10
"""

ORACLES["op8_mixing"] = f"""
with recursive
sized as (select doc_id, source, len({WORDS.format("coalesce(text, '')")}) as size, md5('mix:' || coalesce(doc_id::varchar, '')) as key from documents),
sources as (
  select source, sum(size)::double as s, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::bigint]::double as w
  from sized group by source
),
-- Sources stop in the order of ceiling to weight.
ordered as (select *, row_number() over (order by s / w, source nulls last) as o from sources),
levels as (
  select *, (sum(s) over () - 3 * coalesce(sum(s) over (order by o rows between unbounded preceding and 1 preceding), 0))
    / sum(w) over (order by o rows between current row and unbounded following) as level
  from ordered
),
cut as (select min(o) as o from levels where level * w <= 3 * s),
targets as (
  select l.source, l.s::bigint as source_size, case when l.o < cut.o then 3 * l.s else l.w * f.level end as target
  from levels l, cut, levels f where f.o = cut.o
),
placed as (
  select *, sum(size) over (partition by source order by key, doc_id rows unbounded preceding) - size as ahead from sized
)
select doc_id, size::bigint as size, source_size, target,
  (case when source_size > 0 then floor(target)::bigint // source_size * size
    + greatest(0, least(size, floor(target)::bigint % source_size - ahead)) else 0 end)::bigint as taken
from placed join targets on placed.source is not distinct from targets.source
"""

ORACLES["op12_hard_negatives"] = """
with usable as (
  select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
    list_sum(list_transform(list_zip(a.v, c.v), lambda x: x[1] * x[2]))::bigint as score
  from usable a join usable c on a.vec_id % 50 = 0 and c.vec_id <> a.vec_id and len(c.v) = len(a.v)
),
positives as (
  select * from scored where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
),
ranked as (
  select p.anchor_id, p.vec_id as positive_id, p.score as positive_score, n.vec_id as negative_id, n.score as negative_score,
    row_number() over (partition by p.anchor_id, p.vec_id order by n.score desc, n.vec_id) as rank
  from positives p join scored n on n.anchor_id = p.anchor_id and not n.same
    and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from ranked where rank <= 3
"""

ORACLES["op13_lines"] = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
  from documents
),
keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from lines
),
judged as (select *, length(key) >= 10 and min(doc_id) over (partition by key) < doc_id as gone from keyed)
select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from judged group by doc_id
"""
