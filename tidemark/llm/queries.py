"""The operators' queries over whole tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bit_sliced, bloom_lm, bpe, exact_dedup, html_extract, importance, jaccard_join, line_dedup, mixing, quality, ranked_search, token_counts, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_wrapper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_extract.extract(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan_mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_exact(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels"))


def op6_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(_table(spark, sf_dir, "documents"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(_table(spark, sf_dir, "documents"), contents=False)


def op8_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")).drop("passages")


def op9_bit_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_sliced.top_k(_table(spark, sf_dir, "embeddings"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), words=4, num=85, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), n=1, buckets=10_000, percent=10, min_words=20, seed=2024)
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = token_counts.count_tokens(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=50)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_wrapper_text, op2_line_dedup, op3_source_mixing, op4_exact_dedup, op5_compression_quality, op6_bloom_lm, op7_byte_bpe, op8_toxic_segments, op9_bit_sliced_topk, op10_jaccard_join, op11_importance_resampling, op12_token_counts, op13_ranked_search)}

BLANK = r"[\x20\x09-\x0D]"

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": rf"""
with lines as (
  select doc_id, u.pos, u.line,
         translate(regexp_replace(regexp_replace(u.line, '^{BLANK}+', ''), '{BLANK}+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x, i: {{'pos': i, 'line': x}})) as u from documents)),
owner as (select k, min(doc_id) as own from lines where length(k) >= 10 group by k),
judged as (select l.doc_id, l.pos, l.line, coalesce(o.own < l.doc_id, false) as gone from lines l left join owner o on l.k = o.k)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from judged group by doc_id""",
    "op9_bit_sliced_topk": """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (
  select a.vec_id as query_id, b.vec_id, list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score
  from v a join v b on a.vec_id % 20 = 0 and a.vec_id <> b.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as r from pairs)
select query_id, r::integer as rank, vec_id, score from ranked where r <= 20""",
    "op4_exact_dedup": rf"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '{BLANK}+', ' ', 'g') as norm from documents)
select doc_id, min(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
       doc_id = min(doc_id) over (partition by norm) as kept, sha256(norm) as text_sha256
from t""",
    "op11_importance_resampling": r"""
with crc as (select list_transform(range(256), lambda i: list_reduce(list_concat([i::bigint], range(8)), lambda c, step: xor(c >> 1, 3988292384 * (c & 1)))) as t),
words as (
  select 0 as wanted, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w from documents
  union all
  select 1, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) from benchmark),
bags as (select wanted, doc_id, w, count(*) as n from words group by all),
bytes as (
  select w, list_transform(range(1, strlen(w) + 1), lambda i: ('0x' || substr(hex(encode(w)), 2 * i - 1, 2))::bigint) as b
  from (select distinct w from bags)),
hashed as (
  select w, xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) % 10000 as bucket from bytes, crc),
sums as (select bucket, sum(n) filter (where wanted = 0) as s, sum(n) filter (where wanted = 1) as t from bags join hashed using (w) group by bucket),
gains as (
  select bucket, floor(1000 * ln((coalesce(t, 0)::double + 1) * ((sum(s) over ())::double + 10000) / ((coalesce(s, 0)::double + 1) * ((sum(t) over ())::double + 10000))))::bigint as gain from sums),
weighed as (
  select doc_id, sum(n)::bigint as n_features, floor(sum(n * gain)::double / sum(n)::double)::bigint as weight
  from bags join hashed using (w) join gains using (bucket) where wanted = 0 group by doc_id),
scored as (
  select d.doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::bigint + 0.5) / 4294967296)))::bigint as score
  from documents d left join weighed using (doc_id)),
ranked as (
  select doc_id, row_number() over (order by score desc, doc_id) as r, count(*) over () as n from scored where n_features >= 20)
select doc_id, n_features, weight, score, case when r <= 10 * n // 100 then r end as rank from scored left join ranked using (doc_id)""",
    "op13_ranked_search": r"""
with d as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
items as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
sizes as (select doc_id, count(*) as n from d group by doc_id),
whole as (select count(*) as big_n, sum(n)::bigint as big_l from sizes),
tfs as (select doc_id, term, count(*) as tf from d where term in (select term from items) group by all),
weights as (select term, floor(1000 * ln((2 * any_value(big_n) + 2)::double / (2 * count(*) + 1)::double))::bigint as w from tfs, whole group by term),
scores as (
  select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::bigint as score
  from items join weights using (term) join tfs using (term) join sizes using (doc_id), whole group by all),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as r from scores where score > 0)
select item_id, r::integer as rank, doc_id, score from ranked where r <= 50""",
}
