"""The registered queries of this subpackage and their SQL counterparts."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breezemart.llm import ball_codes, embeddings, exact_dedup, filter_audit, line_dedup, mixing, near_dedup, packing, pii, prefix_bpe, range_coder, sharding, toxicity
from breezemart.llm.shared import table
from breezemart.llm.tokens import vocabulary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

SHARDS = 24


def query(function: Callable[[SparkSession, str], DataFrame]) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), [1.0] * SHARDS)


@query
def op2_range_coded_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_coder.coded_ids(table(spark, sf_dir, "documents"), vocabulary())


@query
def op3_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_embeddings(table(spark, sf_dir, "embeddings"))


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


@query
def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query
def op6_deletion_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_repeats(table(spark, sf_dir, "documents"))


@query
def op7_prob_min_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


@query
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


@query
def op9_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = toxicity.prepared(table(spark, sf_dir, "documents"))
    return toxicity.toxicity(texts, toxicity.fit(texts, table(spark, sf_dir, "labels")))


@query
def op10_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


@query
def op11_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.digests(prefix_bpe.round_trip(table(spark, sf_dir, "documents"), prefix_bpe.vocabulary()))


@query
def op12_ball_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ball_codes.compress(table(spark, sf_dir, "embeddings"))
    return ball_codes.with_label_errors(found.codes).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(ball_codes.books_digest(found.books)).alias("codebooks_sha256"))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


NORMAL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE["op4_exact_dedup"] = f"""
with d as (select doc_id, sha256({NORMAL}) as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from d group by 1)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256
from d join g using (text_sha256)
"""

MIX = r"""
words as (
  select doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size
  from documents),
keyed as (
  select doc_id, source, size,
         -ln((('0x' || substr(md5(coalesce(doc_id::varchar, 'null')), 1, 12))::bigint::double + 0.5)
             / 281474976710656.0)
         / case when size > 0 then size::double
                / (size + length(text) - length(regexp_replace(text, '[#$%&*|!]', '', 'g')))
           else 1.0 end as k
  from words),
sizes as (select source, sum(size)::bigint as source_size from keyed group by 1),
caps as (
  select source, source_size, 3.0::double * source_size as cap,
         ([1.0, 2.0, 3.0]::double[])[1 + (row_number() over (order by source nulls last) - 1) % 3] as w
  from sizes),
levels as (
  select *, cap / w as ratio,
         (sum(source_size) over () - coalesce(sum(cap) over (
            order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0))
         / sum(w) over (order by cap / w, source nulls last
                        rows between current row and unbounded following) as level
  from caps),
goals as (
  select source, source_size,
         coalesce(least(cap, (max(case when level <= ratio then level end) over ()) * w), cap) as target
  from levels),
parts as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs
  from goals),
summed as (
  select doc_id, size, source_size, target, epochs, target - epochs * source_size as rest,
         sum(size) over (partition by keyed.source order by k, doc_id, size
                         rows between unbounded preceding and current row) as so_far
  from keyed join parts on keyed.source is not distinct from parts.source),
mixed as (
  select doc_id, size, source_size, target,
         (size * (epochs + case when so_far <= rest
                                or (so_far - size < rest and so_far - rest <= rest - (so_far - size))
                           then 1 else 0 end))::bigint as taken
  from summed)
"""

ORACLE["op5_source_mix"] = f"with {MIX} select * from mixed"

ORACLE["op3_projection_forest"] = """
with recursive v as (
  select vec_id, label, embedding::double[] as e,
         sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))) as norm
  from embeddings where label is not null),
good as (select * from v where norm > 0 and isfinite(norm)),
link as (
  select a.vec_id as a, b.vec_id as b from good a join good b on a.label = b.label and a.vec_id <> b.vec_id
  where list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93),
reach as (
  select vec_id as node, vec_id as other from good
  union
  select reach.node, link.b from reach join link on reach.other = link.a),
c as (select node, min(other) as component_id from reach group by 1),
n as (select a, count(*) as n_links from link group by 1)
select e.vec_id, coalesce(n_links, 0)::bigint as n_links, coalesce(component_id, e.vec_id) as component_id,
       e.vec_id = coalesce(component_id, e.vec_id) as kept
from embeddings e left join c on c.node = e.vec_id left join n on n.a = e.vec_id
"""

ORACLE["op13_filter_audit"] = r"""
with marks as (
  select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by 1),
d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
m as (
  select d.part, coalesce(good, false)::integer as good, coalesce(toxic, false)::integer as toxic,
         [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
          100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 10 * length(t),
          regexp_matches(t, '[#$%&*|]'),
          coalesce(d.doc_id > min(d.doc_id) over (partition by t), false)] as f
  from d left join marks on d.doc_id = marks.doc_id),
c as (
  select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic, list_sum(f::integer[]) as failed
  from m group by 1, 2),
letters(l) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
  select a.l || b.l || c.l || d.l || e.l as filter_order
  from letters a, letters b, letters c, letters d, letters e
  where len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
places as (
  select filter_order, step::integer as step, substr(filter_order, step, 1) as letter,
         list_transform(string_split(substr(filter_order, 1, step - 1), ''), lambda x: ascii(x) - 64) as past
  from orders, range(1, 6) r(step)),
held as (
  select part, filter_order, step, letter, n, good, toxic, f[ascii(letter) - 64] as fails, failed,
         len(list_filter(past, lambda x: x between 1 and 5 and f[x])) > 0 as gone
  from c, places),
steps as (
  select part, filter_order, step, letter,
         coalesce(sum(n) filter (where not gone and not fails), 0)::bigint as kept,
         coalesce(sum(n) filter (where not gone and fails), 0)::bigint as removed,
         coalesce(sum(n) filter (where gone and fails), 0)::bigint as redundant,
         coalesce(sum(n) filter (where fails and failed = 1), 0)::bigint as unique_fails,
         coalesce(sum(good) filter (where not gone and fails), 0)::bigint as good_lost,
         coalesce(sum(toxic) filter (where not gone and fails), 0)::bigint as toxic_lost
  from held group by all)
select * exclude (letter), (sum(removed) over (partition by part, letter))::bigint as shapley from steps
"""


def _k_means_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Plain k-means, every entry compared, a pair of steps for each round."""
    steps = [f"""
good as (
  select row_number() over (order by vec_id nulls last, embedding) as r, vec_id, label, embedding
  from embeddings
  where embedding is not null and len(embedding) > 0
    and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))),
x as materialized (
  select r, p::integer as p,
         list_transform(embedding[len(embedding) // {parts} * p + 1 : len(embedding) // {parts} * (p + 1)],
                        lambda v: floor(4096 * v::double)::bigint) as v
  from good, range({parts}) t(p)),
b0 as materialized (select p, (r - 1)::integer as e, v as c from x where r <= {entries})"""]

    def nearest(books: str) -> str:
        square = "list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
        return (f"select r, x.p, min(({square}, e)) as best, any_value(v) as v "
                f"from x join {books} b on x.p = b.p group by 1, 2")

    for k in range(rounds):
        steps.append(f"""
a{k} as materialized ({nearest(f"b{k}")}),
s{k} as (
  select p, e, list(m order by pos) as c
  from (select p, best[2] as e, pos, floor_div(sum(v[pos])::hugeint, count(*))::bigint as m
        from a{k}, range(1, (select max(len(v)) from x) + 1) t(pos) group by 1, 2, 3) group by 1, 2),
b{k + 1} as materialized (
  select b{k}.p, b{k}.e, coalesce(s{k}.c, b{k}.c) as c from b{k} left join s{k} on b{k}.p = s{k}.p and b{k}.e = s{k}.e)""")
    last = f"b{rounds}"
    floor_div = "(({0}) - ((({0}) % ({1})) + ({1})) % ({1})) // ({1})"
    text = ",".join(steps).replace("floor_div(sum(v[pos])::hugeint, count(*))",
                                   floor_div.format("sum(v[pos])::hugeint", "count(*)"))
    return f"""
with {text},
final as materialized ({nearest(last)}),
coded as (
  select r, string_agg(printf('%02x', best[2]), '' order by p) as code, sum(best[1])::bigint as error
  from final group by 1),
digest as (
  select sha256(string_agg(list_aggregate(c, 'string_agg', ','), ',' order by p, e)) as codebooks_sha256 from {last})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded join good using (r), digest
"""


ORACLE["op12_ball_codes"] = _k_means_sql()
