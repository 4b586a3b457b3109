"""Queries of the numbered operators: name -> f(spark, sf_dir), and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.llm import best_fit, bpe_codec, centroid_tree, fill_middle, jaccard_join, lm_score, multi_index, quality_rules, secret_scan, source_mix, suffix_dedup, token_counts, winnowing
from zonecast.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(of: str | Column, by: int) -> Column:
    """crc32 of an id as text, modulo ``by``."""
    return F.crc32(F.col(of).cast("string").cast("binary")) % by


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=90)


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_codec.digest(bpe_codec.encode(docs, path, public_tokenizers.PATTERN))


def op4_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.coalesce(remainder("doc_id", 7) == 2, F.lit(False)).alias("held_out"))
    return lm_score.score(docs, lm_score.fit(docs.where("not held_out").select("text")))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.edited_likeness(table(spark, sf_dir, "documents"), unit="mixed")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(secret_scan.find(table(spark, sf_dir, "documents")))


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of each document under the default mix, with its place in the last
    epoch, and under budgets of a half and of three halves of all tokens."""
    rows = materialize(source_mix.sizes(table(spark, sf_dir, "documents")), "op9-sizes")
    every = rows.agg(F.sum("__tokens")).first()[0] or 0
    out = source_mix.taken(rows).withColumnsRenamed({"copies": "n_copies", "__place": "place"}).drop("weight", "epochs")
    for name, budget in (("half", every * 0.5), ("more", every * 1.5)):
        out = materialize(out, "op9-mix")
        out = source_mix.taken(out, budget=budget).withColumnRenamed("copies", f"n_copies_{name}").drop("weight", "epochs", "__place")
    return out.select(
        F.col("__id").alias("doc_id"), F.when(F.col("__source") != "", F.substr("__source", F.lit(2))).alias("source"),
        F.col("__tokens").alias("n_tokens"), "n_copies", "place", "n_copies_half", "n_copies_more")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = quality_rules.train(docs, table(spark, sf_dir, "labels"), remainder("doc_id", 5) != 0)
    return quality_rules.score(docs.select("doc_id", "text"), rules).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op11_centroid_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_tree.cluster(table(spark, sf_dir, "embeddings"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return best_fit.pack(best_fit.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN))


def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_bpe_codec": op3_bpe_codec,
    "op4_lm_score": op4_lm_score,
    "op5_token_counts": op5_token_counts,
    "op6_winnowing": op6_winnowing,
    "op7_secret_scan": op7_secret_scan,
    "op8_multi_index": op8_multi_index,
    "op9_source_mix": op9_source_mix,
    "op10_quality_rules": op10_quality_rules,
    "op11_centroid_tree": op11_centroid_tree,
    "op12_best_fit": op12_best_fit,
    "op13_fill_middle": op13_fill_middle,
}


def _lloyd_sql(k: int, rounds: int, dim: int) -> str:
    """Lloyd's rounds over integer vectors, every centroid compared."""
    steps = [f"""v as (
  select row_number() over () as r, vec_id, list_transform(embedding::double[], lambda x: floor({dim} * x)::bigint) as v
  from embeddings
  where len(embedding) = {dim} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as (select row_number() over (order by sha256('1:' || coalesce(vec_id::varchar, 'null')), v) - 1 as c, v as m
       from v qualify c < {k})"""]
    d = f"list_sum(list_transform(range(1, {dim + 1}), lambda i: (v.v[i] - x.m[i]) * (v.v[i] - x.m[i])))::bigint"
    for i in range(rounds + 1):
        steps.append(f"""a{i} as (select r, vec_id, v, min(struct_pack(d, c)) as b
       from (select v.r, v.vec_id, v.v, x.c, {d} as d from v cross join c{i} x) group by all)""")
        steps.append(f"""c{i + 1} as (
  select x.c, coalesce(n.m, x.m) as m from c{i} x left join (
    select c, list((s - ((s % n) + n) % n) // n order by i)::bigint[] as m from (
      select b.c as c, i, sum(v[i]) as s, count(*) as n from a{i}, range(1, {dim + 1}) t(i) group by 1, 2)
    group by c) n using (c))""")
    return f"""with {", ".join(steps)}
select a.vec_id, a.b.c::int as cluster, a.b.d as distance, (sum(a.b.d) over (partition by a.b.c))::bigint as cluster_inertia,
       (sum(a.b.d) over ())::bigint as inertia, sha256(array_to_string(x.m, ',')) as centroid_sha256
from a{rounds} a join c{rounds} x on x.c = a.b.c"""


SQL: dict[str, str] = {
    "op2_jaccard_join": r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as w
  from documents),
s as (
  select distinct doc_id, unnest(case when len(w) >= 3
           then list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
           when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g
  from w),
n as (select doc_id, count(*) as n from s group by doc_id),
pairs as (select x.doc_id as a, y.doc_id as b, count(*) as c
         from s x join s y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2),
l as (select a, b from pairs join n p on p.doc_id = a join n q on q.doc_id = b
      where 100 * c >= 90 * (p.n + q.n - c)),
r as (select doc_id, doc_id as c from documents union select r.doc_id, l.b from r join l on r.c = l.a)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, r.c as component_id
from documents d left join n using (doc_id)
join (select doc_id, min(c) as c from r group by doc_id) r using (doc_id)""",
    "op8_multi_index": """
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
      where len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.93),
r as (select vec_id, vec_id as c from embeddings union select r.vec_id, l.b from r join l on r.c = l.a),
n as (select a, count(*) as n from l group by a)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, r.c as component_id, e.vec_id = r.c as kept
from embeddings e left join n on n.a = e.vec_id
join (select vec_id, min(c) as c from r group by vec_id) r on r.vec_id = e.vec_id""",
    "op9_source_mix": r"""
with recursive d as (
  select source, doc_id, sum(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0))::bigint as n
  from documents group by source, doc_id),
s as (select source, sum(n)::double as t from d group by source),
z as (select sum(t) as every, list(t / (select sum(t) from s) order by t) as shares, max(t) as most, min(t) as least from s where t > 0),
f(mix, share) as (values ('half', 0.5::double), ('more', 1.5::double)),
-- the exponent is bisected: high meets the repetition limit of 2, low does not
b as (
  select mix, share, shares, 0 as i, 0::double as low,
         case when share / shares[1] / len(shares) <= 2 then 0::double else 1::double end as high from f, z
  union all
  select mix, share, shares, i + 1,
         case when share * pow(shares[1], m - 1) / list_sum(list_transform(shares, lambda x: pow(x, m))) <= 2 then low else m end,
         case when share * pow(shares[1], m - 1) / list_sum(list_transform(shares, lambda x: pow(x, m))) <= 2 then m else high end
  from (select *, (low + high) / 2 as m from b where i < 45)),
x as (select 'all' as mix, case when most > least then greatest(0, 1 - ln(2) / (ln(most) - ln(least))) else 0 end as a from z
      union all select mix, high from b where i = 45),
w as (select mix, source, t, pow(t / every, a) as w, every from s, x, z where t > 0),
e as (select mix, source, t, round(case mix when 'all' then w / t / min(w / t) over (partition by mix)
             else w / sum(w) over (partition by mix) * every * case mix when 'half' then 0.5 else 1.5 end / t end, 6) as epochs from w
      union all select mix, source, t, 1.0 from s, x where t = 0),
q as (select d.*, mix, epochs, (epochs - floor(epochs)) * e.t as budget,
             md5('mix:' || floor(epochs)::bigint || ':' || coalesce(doc_id::varchar, 'null')) as place
      from d join e on d.source is not distinct from e.source),
p as (select *, sum(n) over (partition by mix, source order by place, doc_id rows unbounded preceding) as upto from q),
c as (select *, (floor(epochs) + case when upto <= budget and n > 0 then 1 else 0 end)::bigint as copies from p)
select doc_id, source, n as n_tokens, max(copies) filter (mix = 'all') as n_copies, max(place) filter (mix = 'all') as place,
       max(copies) filter (mix = 'half') as n_copies_half, max(copies) filter (mix = 'more') as n_copies_more
from c group by all""",
    "op11_centroid_tree": _lloyd_sql(16, 3, 64),
    "op13_fill_middle": """
with h as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n,
         sha256('1:' || coalesce(doc_id::varchar, 'null')) as h
  from documents),
g as (select *, [('0x' || substr(h, 1 + 8 * i, 8))::bigint for i in range(4)] as d from h),
c as (
  select *, least(d[1] % (n + 1), d[2] % (n + 1)) as a, greatest(d[1] % (n + 1), d[2] % (n + 1)) as b,
         case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or d[3] % 100 >= 90 then 'plain'
              when d[4] % 100 < 20 then 'spm' else 'psm' end as form
  from g),
x as (select *, substring(t, 1, a) as p, substring(t, a + 1, b - a) as m, substring(t, b + 1) as s from c)
select doc_id, n::bigint as n, form, case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from x""",
}
