"""The registered queries of the training-data operators and, where SQL can express them, their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_encode
from .decontaminate import contamination
from .exactdedup import exact_duplicates
from .hardneg import hard_negatives
from .htmlextract import op6
from .linededup import dedup_lines
from .quality import op10
from .setjoin import similar_components
from .sharding import hilbert_shards
from .substrings import remove_repeats
from .tokencount import count_tokens, stored, token_files
from .toxicity import op2
from .veccode import coded_vectors

#: Outside the vocabulary, whose ids end at 49407: texts can hold special tokens.
END_OF_DOCUMENT = 65535


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_components(_documents(spark, sf_dir), width=3, threshold=0.9)


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = stored(token_files(_documents(spark, sf_dir), word_vocabulary(), END_OF_DOCUMENT))
    return count_tokens(blocks, END_OF_DOCUMENT).select("doc_id", "n_tokens")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = contamination(_documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = hilbert_shards(_documents(spark, sf_dir))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(_documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(_documents(spark, sf_dir), word_vocabulary(), ("n_tokens", "ids_sha256", "decoded_sha256"), keep=("doc_id",))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_documents(spark, sf_dir))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coded_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), parts=16, entries=64, rounds=2, scale=256.0)


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_documents(spark, sf_dir), window=35, columns=("n_words", "n_removed", "kept_sha256"))


QUERIES = {
    "op1_ngram_jaccard_join": op1,
    "op2_toxicity": op2,
    "op3_token_counts": op3,
    "op4_benchmark_decontamination": op4,
    "op5_sharding": op5,
    "op6_html_extraction": op6,
    "op7_line_dedup": op7,
    "op8_bpe_encode_decode": op8,
    "op9_exact_dedup": op9,
    "op10_quality_classifier": op10,
    "op11_vector_code_compression": op11,
    "op12_hard_negative_mining": op12,
    "op13_substring_dedup": op13,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_VECTORS = """v as materialized (
  select vec_id, label, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)"""


def _nearest(k: int) -> str:
    """The nearest entry of each part in the codebooks of round k."""
    return f"""
  select vec_id, part, min({{'dist': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'entry': entry}}) as n
  from p join b{k} using (part) group by vec_id, part"""


def _lloyd(k: int) -> str:
    """Round k: each part's entry, and the codebooks that follow."""
    return f"""a{k} as materialized ({_nearest(k)}),
b{k + 1} as materialized (
  with m as (select part, n.entry as entry, k, floor(sum(x[k]) / count(*))::bigint as c from a{k} join p using (vec_id, part), (select unnest(range(1, len(x) + 1)) as k) group by all),
  l as (select part, entry, list(c order by k) as c from m group by part, entry)
  select part, entry, coalesce(l.c, b.c) as c from b{k} b left join l using (part, entry))"""


ORACLE_SQL = {
    "op1_ngram_jaccard_join": f"""
with recursive words as (
  select doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' '))) end as s from words),
tokens as (select doc_id, len(s) as n, unnest(s) as t from sets),
pairs as (
  select a.doc_id as x, b.doc_id as y from tokens a join tokens b on a.t = b.t and a.doc_id < b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 90 * (a.n + b.n - count(*))),
links as (select x, y from pairs union all select y, x from pairs),
reach as (
  select doc_id as x, doc_id as y from documents
  union
  select r.x, l.y from reach r join links l on r.y = l.x)
select s.doc_id, len(s.s)::bigint as n_shingles, min(r.y) as component_id
from sets s join reach r on r.x = s.doc_id group by s.doc_id, len(s.s)""",
    "op4_benchmark_decontamination": f"""
with dw as (select doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
bw as (select item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
bwin as (
  select distinct item_id, least(13, len(w)) as k, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i:i+least(13, len(w))-1], ' '))) as g
  from bw where len(w) > 0),
sizes as (select distinct k from bwin),
dwin as (
  select doc_id, k, unnest(range(1, len(w) - k + 2)) as i, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) as g
  from dw, sizes where len(w) >= k),
hits as (select d.doc_id, d.i, d.k, b.item_id from dwin d join bwin b on d.k = b.k and d.g = b.g),
positions as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + k)) as p from hits) group by doc_id),
items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(p.n_hit, 0)::bigint as n_hit, coalesce(i.n_items, 0)::bigint as n_items,
  sha256(coalesce(i.names, '')) as items_sha256,
  coalesce(p.n_hit, 0) > 0 and 20 * coalesce(p.n_hit, 0) >= len(d.w) as contaminated
from dw d left join positions p using (doc_id) left join items i using (doc_id)""",
    "op9_exact_dedup": f"""
with n as (select doc_id, {_LOWER} as t from documents)
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size, doc_id = max(doc_id) over g as kept, sha256(t) as text_sha256
from n window g as (partition by t)""",
    "op11_vector_code_compression": f"""
with {_VECTORS},
p as materialized (
  select vec_id, part, q[part * len(q) // 16 + 1 : (part + 1) * len(q) // 16] as x from v, (select unnest(range(16)) as part)),
b0 as materialized (select part, dense_rank() over (order by vec_id) - 1 as entry, x as c from p qualify entry < 64),
{_lloyd(0)},
{_lloyd(1)},
a2 as materialized ({_nearest(2)}),
codes as (select vec_id, string_agg(printf('%02x', n.entry), '' order by part) as code, sum(n.dist)::bigint as error from a2 group by vec_id)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error,
  (select sha256(string_agg(array_to_string(c, ','), ',' order by part, entry)) from b2) as codebooks_sha256
from codes join v using (vec_id)""",
    "op12_hard_negative_mining": f"""
with {_VECTORS},
r as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, q::double[] as q from v where label is not null),
s as materialized (
  select a.vec_id as a, r.vec_id as b, a.label = r.label as same, list_dot_product(a.q, r.q)::bigint as score
  from r a, r where a.vec_id % 50 = 0 and a.vec_id <> r.vec_id),
pos as (select a, b, score from s where same qualify row_number() over (partition by a order by score desc, b) <= 5)
select pos.a as anchor_id, pos.b as positive_id, row_number() over (partition by pos.a, pos.b order by s.score desc, s.b)::int as rank,
  s.b as negative_id, pos.score as positive_score, s.score as negative_score
from pos join s on s.a = pos.a and not s.same and 50 * pos.score <= 100 * s.score and 100 * s.score <= 95 * pos.score
qualify rank <= 3""",
    "op13_substring_dedup": """
with d as materialized (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
win as materialized (
  select r, unnest(range(1, len(w) - 33)) as i, unnest(list_transform(range(1, len(w) - 33), lambda i: array_to_string(w[i:i+34], ' '))) as g from d where len(w) >= 35),
hit as (select distinct r, unnest(range(i, i + 35)) as p from win where g in (select g from win group by g having count(*) > 1)),
words as (select r, unnest(range(1, len(w) + 1)) as p, unnest(w) as x from d),
kept as (select r, string_agg(x, ' ' order by p) as t, count(*) as n from words anti join hit using (r, p) group by r)
select doc_id, len(w)::bigint as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256 from d left join kept using (r)""",
}
