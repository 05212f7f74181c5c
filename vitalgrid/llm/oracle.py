"""DuckDB equivalents of the registered corpus queries, where SQL can express them."""

from __future__ import annotations

WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

TOKEN_ROLLUP = r"""
with kept as (
  select max(doc_id) as doc_id from documents group by coalesce(text, '')),
left_over as (
  select d.*, coalesce(text, '') as t from documents d join kept using (doc_id)),
counted as (
  select source, lang, 'words/1' as tokenizer,
    len(regexp_extract_all(array_to_string(list_distinct(string_split(t, chr(10))), chr(10)),
                           '[^\x20\x09-\x0D]+')) as n from left_over
  union all
  select source, lang, 'words/2',
    len(regexp_extract_all(t, '[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]')) from left_over)
select source, lang, tokenizer, count(*) as documents, sum(n)::bigint as tokens
from counted group by source, lang, tokenizer
"""

EXACT_DEDUP = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""

NEAR_DEDUP = r"""
with recursive
worded as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as words from documents),
placed as (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i
           from worded where len(words) > 0),
shingled as (select distinct doc_id, array_to_string(words[i:i + 4], ' ') as shingle from placed),
sized as (select doc_id, count(*) as n from shingled group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from shingled a join shingled b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from shared s join sized x on x.doc_id = a join sized y on y.doc_id = b
  where 100 * s.n >= 85 * (x.n + y.n - s.n)),
both_ways as (select a, b from links union all select b, a from links),
reached as (
  select doc_id, doc_id as other from documents
  union select r.doc_id, e.b from reached r join both_ways e on e.a = r.other),
named as (select doc_id, min(other) as component_id from reached group by doc_id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from named left join sized using (doc_id)
"""

MIXING = rf"""
with sized as (
  select doc_id, source, {WORDS} as size, md5(cast(doc_id as varchar)) as hash from documents),
classed as (select *, cast(floor(log2(size + 1.0::double) * 8) as int) as class from sized),
totals as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
  select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight,
         3 * source_size as cap from totals),
leveled as (
  select *, case when sum(weight) over () > coalesce(sum(weight) over before, 0) then
    (sum(source_size) over () - coalesce(sum(cap) over before, 0))::double
    / (sum(weight) over () - coalesce(sum(weight) over before, 0))::double end as own_level,
    row_number() over (order by cap / weight::double, source nulls last) as pos
  from weighed
  window before as (order by cap / weight::double, source nulls last
                    rows between unbounded preceding and 1 preceding)),
targets as (
  select *, least(cap::double, weight * (select arg_min(own_level, pos) from leveled
                                         where cap >= own_level * weight)) as target from leveled),
numbered as (
  select d.*, t.source_size, t.target,
    row_number() over (partition by d.source order by class, hash, doc_id) as pos,
    case when t.source_size > 0 then t.target / t.source_size else 0 end as expected,
    ('0x' || substr(md5('0:' || coalesce(d.source, chr(0))), 1, 8))::bigint / 4294967296::double as shift
  from classed d join targets t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
  ((floor(pos * expected + shift) - floor((pos - 1) * expected + shift)) * size)::bigint as taken
from numbered
"""

NGRAM_JOIN = NEAR_DEDUP.replace("85 *", "80 *").replace(", doc_id = component_id as kept", "")


def _clustering(rounds: int = 3) -> str:
    """Centroids move in ``rounds`` rounds; each vector goes to the nearest, the smaller number of equals."""
    def nearest(number: int) -> str:
        return f"""
near{number} as materialized (
  select id, vec_id, v, arg_min(c, (dist, c)) as c, min(dist) as dist from (
    select k.id, k.vec_id, k.v, m.c,
      list_sum(list_transform(list_zip(k.v, m.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as dist
    from kept k, mean{number} m) group by id, vec_id, v)"""

    def moved(number: int) -> str:
        return f"""
mean{number + 1} as materialized (
  select m.c, coalesce(n.v, m.v) as v from mean{number} m left join (
    select c, list(((s - ((s % n + n) % n)) // n)::bigint order by i) as v from (
      select c, i, sum(x)::bigint as s, count(*) as n from (
        select c, unnest(v) as x, unnest(range(len(v))) as i from near{number}) group by c, i) group by c) n
    on n.c = m.c)"""

    steps = ",".join(nearest(r) + "," + moved(r) for r in range(rounds)) + "," + nearest(rounds)
    return f"""
with kept as materialized (
  select row_number() over () as id, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v
  from embeddings where len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
mean0 as materialized (
  select row_number() over (order by h, v) - 1 as c, v from (
    select sha256('1:' || coalesce(vec_id::varchar, '')) as h, v from kept order by h, v limit 16)),{steps},
summed as (select c, sum(dist)::bigint as d from near{rounds} group by c)
select vec_id, n.c::int as cluster, dist as distance, s.d as cluster_inertia,
  (select sum(d)::bigint from summed) as inertia,
  sha256(array_to_string(list_transform(m.v, lambda x: x::varchar), ',')) as centroid_sha256
from near{rounds} n join summed s on s.c = n.c join mean{rounds} m on m.c = n.c
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_token_rollup": TOKEN_ROLLUP, "op4_near_dedup": NEAR_DEDUP,
            "op8_exact_dedup": EXACT_DEDUP, "op9_mixing": MIXING,
            "op11_ngram_join": NGRAM_JOIN, "op13_bisector_clusters": _clustering()}
