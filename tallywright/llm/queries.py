"""The numbered queries of this subpackage over the driver's tables, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import bpe, centroids, chat, decontaminate, fingerprints, html_text, language, merkle, mixing, phrase_dedup, secrets, simhash_dedup, suffix_dedup
from .common import table


def hex16(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op2_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrase_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "n_words", F.round("similarity", 9).alias("similarity"))


#: Every window that shares a shingle with an item of its size, wherever that stands, without fingerprints.
OP3_SQL = """
with dw as (
  select doc_id, list_filter(regexp_split_to_array(lower(text), '[ \t-\r]+'), lambda x: x <> '') as w from documents where text is not null),
ds as (
  select doc_id, len(w) - 4 as total, unnest(range(1, len(w) - 3)) as pos, w from dw where len(w) >= 5),
d as (select doc_id, total, pos - 1 as pos, array_to_string(w[pos:pos+4], ' ') as h from ds),
iw as (
  select item_id, list_filter(regexp_split_to_array(lower(text), '[ \t-\r]+'), lambda x: x <> '') as w from benchmark where text is not null),
s as (select item_id, len(w) - 4 as n, unnest(range(1, len(w) - 3)) as pos, w from iw where len(w) >= 5),
i as (select item_id, n, array_to_string(w[pos:pos+4], ' ') as h, count(*) as times from s group by all),
met as (select doc_id, total, pos, h, item_id, n, times from d join i using (h)),
win as (
  select distinct doc_id, item_id, unnest(range(greatest(0, least(pos - n + 1, total - n)), greatest(0, least(pos, total - n)) + 1)) as start from met),
held as (
  select doc_id, item_id, start, h, any_value(n) as n, any_value(least(n, total)) as own, least(count(*), any_value(times)) as both_
  from win join met using (doc_id, item_id) where pos >= start and pos < start + n group by doc_id, item_id, start, h),
sim as (
  select doc_id, item_id, start, n, sum(both_)::double / (own + n - sum(both_))::double as similarity from held group by doc_id, item_id, start, n, own),
best as (
  select doc_id, item_id, start::bigint as start, (n + 4)::bigint as n_words, round(similarity, 9) as similarity
  from sim where similarity >= 0.8
  qualify row_number() over (partition by doc_id, item_id order by similarity desc, start) = 1),
short as (select distinct item_id, len(w) as n, array_to_string(w, ' ') as h from iw where len(w) between 1 and 4),
sized as (select doc_id, k, w, unnest(range(1, len(w) - k + 2)) as pos from dw join (select distinct n as k from short) on len(w) >= k),
grams as (select doc_id, k as n, pos - 1 as start, array_to_string(w[pos:pos+k-1], ' ') as h from sized)
select * from best
union all
select doc_id, item_id, min(start)::bigint as start, n::bigint as n_words, 1.0::double as similarity
from grams join short using (n, h) group by doc_id, item_id, n
"""


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


OP4_SQL = """
with d as (
  select doc_id, source, cast(length(regexp_replace(regexp_replace(coalesce(text, ''), '[^ \\t-\\r]+', 'x', 'g'), '[ \\t-\\r]+', '', 'g')) as bigint) as size,
         ('0x' || substr(md5('mix' || coalesce(cast(doc_id as varchar), '')), 1, 15))::bigint as h
  from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
r as (select *, row_number() over (order by source asc nulls last) - 1 as rank from s),
w as (select *, case rank % 3 when 0 then 5 when 1 then 2 else 1 end as weight, 2 * source_size as cap from r),
f as (
  select *, cast(sum(source_size) over () as double) * 1.5::double as total,
         cast(coalesce(sum(cap) over (order by cap::double / weight, rank rows between unbounded preceding and 1 preceding), 0) as double) as before,
         cast(sum(weight) over (order by cap::double / weight, rank rows between current row and unbounded following) as double) as weight_left
  from w),
g as (select *, (total - before) / weight_left as lvl, cap <= weight * ((total - before) / weight_left) as is_full from f),
m as (select *, max(case when not is_full then lvl end) over () as fill from g),
t as (select source, source_size, case when is_full then cast(cap as double) else weight * fill end as target from m),
p as (select *, cast(case when source_size > 0 then floor(target / source_size) else 0 end as bigint) as passes from t),
q as (select *, target - passes * source_size as rest from p),
c as (
  select d.*, source_size, target, passes, rest,
         cast(sum(size) over (partition by d.source order by h) as double) as upto,
         cast(sum(size) over (partition by d.source, h) as double) as here
  from d join q on d.source is not distinct from q.source)
select doc_id, size, source_size, target,
       cast(size * (passes + case when upto <= rest or (upto - here <= rest and upto - rest < rest - (upto - here)) then 1 else 0 end) as bigint) as taken
from c
"""


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.near_classes(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), hex16("fp").alias("fingerprint"), "component_id")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        (language.bucket(F.col("doc_id")) == 2).alias("held_out"),
        F.col("_lang_pred").alias("lang_pred"),
        F.col("_score").alias("score"),
        F.col("_rejected").alias("rejected"),
        F.col("_margin").alias("margin"),
    )


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.edited_prints(table(spark, sf_dir, "documents"))
    prints = [hex16("fp").alias("fingerprint"), hex16("edited_fp").alias("edited_fingerprint")]
    return found.select("doc_id", "n_chars", "edited_sha256", *prints, "near_edited", "near_next", "n_within")


def op8_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat.digest(*chat.format_chats(rows.unionByName(extra)))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = merkle.manifest(table(spark, sf_dir, "documents"))
    digests = [merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")]
    return found.select("doc_id", "leaf", "subroot", "root", *digests)


#: crc32 is spelled out bit by bit; levels climb in recursive expressions.
OP11_SQL = """
with recursive
d as (
  select *, case when list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, (v & 1) * 3988292384))) % 2 = 1
    then replace(text, chr(10), '') else text end as other
  from (select row_number() over () as row, doc_id, source, lang, n_chars, text from documents)),
fields as (
  select row, doc_id, source, coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-') as head,
    coalesce(strlen(text) || ':' || text, '-') as tail, coalesce(strlen(other) || ':' || other, '-') as other_tail
  from d),
hashed as (select row, doc_id, coalesce('1' || source, '0') as grp, sha256(head || tail) as leaf, sha256(head || other_tail) as other from fields),
leaves as (
  select *, row_number() over (partition by grp order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by grp) as size from hashed),
low as (
  select 0 as lv, grp, pos, size, leaf as node from leaves
  union all
  (select lv + 1, grp, pos // 3, (size + 2) // 3, sha256(string_agg(node, '' order by pos)) from low where size > 1 group by lv, grp, pos // 3, size)),
subroots as (select grp, node as subroot, row_number() over (order by grp) - 1 as pos, count(*) over () as size from low where size = 1),
high as (
  select 0 as lv, pos, size, subroot as node from subroots
  union all
  (select lv + 1, pos // 3, (size + 2) // 3, sha256(string_agg(node, '' order by pos)) from high where size > 1 group by lv, pos // 3, size)),
nodes as (select grp, lv, pos, node from low where size > 1 union all select null, 1000 + lv, pos, node from high where size > 1),
steps as (
  select row, n.lv, n.pos, n.node, sign(n.pos - l.pos // (3 ** n.lv)::bigint) as side
  from leaves l join nodes n on n.grp = l.grp and n.pos // 3 = l.pos // (3 ** (n.lv + 1))::bigint
  union all
  select row, n.lv, n.pos, n.node, sign(n.pos - s.pos // (3 ** (n.lv - 1000))::bigint)
  from leaves l join subroots s using (grp) join nodes n on n.grp is null and n.pos // 3 = s.pos // (3 ** (n.lv - 999))::bigint),
path as (
  select row, row_number() over (partition by row order by lv) as k, coalesce(string_agg(node, '' order by pos) filter (where side < 0), '') as l,
    coalesce(string_agg(node, '' order by pos) filter (where side > 0), '') as r
  from steps group by row, lv),
fold as (
  select row, 0 as k, other as node from leaves
  union all
  select f.row, p.k, sha256(p.l || f.node || p.r) from fold f join path p on p.row = f.row and p.k = f.k + 1),
folded as (select row, arg_max(node, k) as folded_root from fold group by row),
proofs as (select row, sha256(coalesce(string_agg(l || r, '' order by k), '')) as proof_sha256 from leaves left join path using (row) group by row)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified
from leaves join subroots using (grp) join folded using (row) join proofs using (row) cross join (select node as root from high where size = 1)
"""


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    found = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return found.select(F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, found = centroids.cluster(table(spark, sf_dir, "embeddings"))
    done = centroids.with_inertia(assigned, found)
    return done.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_sql(k: int = 8, rounds: int = 10) -> str:
    """Rounds one after another: distances by components, the nearest centroid, exact floors of means."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
near{r} as materialized (
  select row, arg_min(k, (d, k)) as k, min(d) as d
  from (select row, k, sum((x - c) * (x - c))::bigint as d from v join c{r} using (dim) group by row, k) group by row),
c{r + 1} as materialized (
  select c{r}.k, dim, coalesce(m, c) as c
  from c{r} left join (select k, dim, (sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*) as m from near{r} join v using (row) group by k, dim) using (k, dim))""")
    return f"""
with kept as materialized (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as q
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64),
v as materialized (select row, unnest(q) as x, unnest(range(64)) as dim from kept),
start as (select row, row_number() over (order by sha256('3:' || vec_id), q) - 1 as k from kept),
c0 as materialized (select k, dim, x as c from start join v using (row) where k < {k}),{",".join(steps)},
total as (select k, sum(d)::bigint as cluster_inertia from near{rounds} group by k),
named as (select k, sha256(string_agg(c::varchar, ',' order by dim)) as centroid_sha256 from c{rounds} group by k)
select vec_id, k::integer as cluster, d as distance, cluster_inertia, (select sum(d)::bigint from near{rounds}) as inertia, centroid_sha256
from near{rounds} join kept using (row) join total using (k) join named using (k)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_main_text": op1_main_text,
        "op2_phrase_dedup": op2_phrase_dedup,
        "op3_decontaminate": op3_decontaminate,
        "op4_mix_sources": op4_mix_sources,
        "op5_simhash_dedup": op5_simhash_dedup,
        "op6_language": op6_language,
        "op7_fingerprints": op7_fingerprints,
        "op8_secret_spans": op8_secret_spans,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_chat_format": op10_chat_format,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_byte_bpe": op12_byte_bpe,
        "op13_centroids": op13_centroids,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontaminate": OP3_SQL,
        "op4_mix_sources": OP4_SQL,
        "op8_secret_spans": secrets.digest_sql(),
        "op11_merkle_manifest": OP11_SQL,
        "op13_centroids": op13_sql(),
    }
