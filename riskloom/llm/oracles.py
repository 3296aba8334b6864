"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from riskloom.llm import line_dedup, mixing, sharding, topk
from riskloom.llm.text import LOWER, UPPER

_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

_COLUMNS = ["doc_id::varchar", "text", "lang", "source", "n_chars::varchar"]
_ROW = "md5(" + " || ".join(f"case when {c} is null then '-' else length({c}) || ':' || {c} end" for c in _COLUMNS) + ")"

_OP3 = f"""
with h as (
  select doc_id, octet_length(encode(coalesce(text, '')))::bigint as n_bytes,
    ('0x' || substr({_ROW}, 1, 15))::bigint as h
  from documents
), at_depth as (
  select h.*, d::int as depth, h >> ({sharding.HASH_BITS} - d::int) as prefix
  from h, range(0, {sharding.HASH_BITS} + 1) t(d)
), sized as (
  select *, sum(n_bytes) over (partition by depth, prefix) as size, count(*) over (partition by depth, prefix) as n
  from at_depth
), leaf as (
  select doc_id, h, n_bytes, min(depth) as depth from sized
  where size <= {sharding.LIMIT_BYTES} or n = 1 group by all
)
select doc_id, substr(lpad(bin(h), {sharding.HASH_BITS}, '0'), 1, depth) as shard, 0::bigint as shard_page, n_bytes
from leaf
"""

_OP4 = f"""
with sizes as (
  select source, count(*) as size, pow(count(*)::double, {mixing.TEMPERATURE}) as share from documents group by source
), rated as (
  select source, 1.0::double * sum(size) over () * share / sum(share) over () / size as rate from sizes
), parts as (
  select *, greatest(1, ceil(rate / {mixing.PART_MEAN})::int) as parts from rated
), terms as (
  select source, parts, k, exp(-(rate / parts)) * pow(rate / parts, k) / gamma(k + 1.0) as term
  from parts, range(0, {mixing.MAX_COUNT} + 1) t(k)
), cumulative as (
  select source, parts, k, sum(term) over (partition by source order by k) as c from terms
), lists as (
  select source, parts, list(c order by k) as cs from cumulative group by all
), drawn as (
  select d.*, list_sum(list_transform(range(1, parts + 1), lambda p: len(list_filter(cs, lambda c: c <=
      ('0x' || substr(md5(concat('42|', coalesce(doc_id::varchar, 'null'), '|', digest, '|', p::varchar)), 1, 13))::bigint
      / {2**52}.0)))) as n
  from (select *, {_ROW} as digest from documents) d join lists l on d.source is not distinct from l.source
)
select doc_id, text, lang, source, n_chars, unnest(range(1, n::bigint + 1))::int as copy from drawn
"""

_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP8 = f"""
with lists as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
lines as (
  select doc_id, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as pos from lists
), keyed as (
  select *, translate(trim(line, {_BLANK}), '{UPPER}', '{LOWER}') as line_key from lines
), repeated as (
  select line_key from keyed where length(line_key) >= {line_dedup.MIN_LENGTH}
  group by line_key having count(distinct doc_id) >= {line_dedup.MIN_DOCUMENTS}
), marked as (
  select k.*, r.line_key is not null as gone from keyed k left join repeated r using (line_key)
)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""

_OP9 = f"""
with lowered as (select doc_id, {_LOWERED} as t from documents),
keyed as (
  select doc_id, t, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size
  from lowered
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from keyed
"""

_OP10 = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor({topk.SCALE} * x::double)::bigint) as q from embeddings
  where embedding is not null and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))
), scored as (
  select a.vec_id as query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 10
"""

ORACLES: dict[str, str] = {
    "op3_extendible_shards": _OP3,
    "op4_poisson_mix": _OP4,
    "op8_line_dedup": _OP8,
    "op9_bloom_exact_dedup": _OP9,
    "op10_branch_and_bound_top_k": _OP10,
}
