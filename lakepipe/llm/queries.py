"""The registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _bucket(n: int):
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


@_query
def op1_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakepipe.llm.quality import quality_scores

    return quality_scores(_table(spark, sf_dir, "documents"))


@_query
def op2_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakepipe.llm.kneser_ney import lm_scores

    return lm_scores(_table(spark, sf_dir, "documents"), _bucket(7) == 2)


@_query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakepipe.llm.secret_scan import secret_findings, train

    docs = _table(spark, sf_dir, "documents")
    return secret_findings(docs, train(docs))


@_query
def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakepipe.llm.cross_polytope import nearest

    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@_query
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakepipe.llm.pii import personal_data

    return personal_data(_table(spark, sf_dir, "documents"))


@_query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakepipe.llm.toxicity import toxicity_scores

    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), _bucket(5) == 0)


@_query
def op7_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakepipe.llm.tiling import contaminated

    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from lakepipe.llm.token_counts import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@_query
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakepipe.llm.ngram_join import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"), n=3, threshold=(90, 100))


@_query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakepipe.llm.mixing import mix_sources

    return mix_sources(_table(spark, sf_dir, "documents"))


@_query
def op11_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakepipe.llm.html_text import extract_text

    return extract_text(_table(spark, sf_dir, "pages"))


@_query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakepipe.llm.hard_negatives import hard_negatives

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, moved)


ORACLES["op12_hard_negatives"] = """
with kept as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as c
  from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)
),
scored as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, list_dot_product(a.c, r.c)::bigint as score
  from kept a join kept r on a.vec_id % 50 = 0 and a.vec_id <> r.vec_id
),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
),
negatives as (
  select anchor_id, positive_id, positive_score, n.vec_id as negative_id, n.score as negative_score,
         row_number() over (partition by anchor_id, positive_id order by n.score desc, n.vec_id) as rank
  from positives join scored n using (anchor_id)
  where not n.same and 50 * positive_score <= 100 * n.score and 100 * n.score <= 95 * positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from negatives where rank <= 3
"""


@_query
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lakepipe.llm.prefix_trie import conversation_paths, trie_nodes, with_base

    conv = F.col("conv")
    keep = F.crc32(conv.cast("string").cast("binary")) % 6
    return trie_nodes(with_base(conversation_paths(_table(spark, sf_dir, "conversations")), conv - conv % 100, keep, 5))


ORACLES["op13_prefix_trie"] = """
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as k
  from conversations where conv_id is not null
),
convs as (
  select conv_id as c, conv_id - conv_id % 100 as base,
         -- CRC-32 of the decimal digits, bit by bit
         xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda ch: ascii(ch)::bigint)),
             lambda x, b: list_reduce(list_prepend(xor(x, b), range(8)), lambda y, i: xor(y >> 1, (y & 1) * 3988292384))), 4294967295) % 6 as h
  from (select distinct conv_id from turns)
),
rebuilt as (
  select c, 0 as part, k, role, text from convs join turns on turns.conv_id = base and k <= h
  union all
  select c, 1 as part, k, role, text from convs join turns on turns.conv_id = c and k > h
),
paths as (
  select c, coalesce(list(struct_pack(r := role, t := text) order by part, k) filter (where k is not null), []) as p
  from convs left join rebuilt using (c) group by c
),
points as (select c, p, unnest(range(0, len(p) + 1)) as d from paths),
nodes as (
  select p[1:d] as node, d, min(c) as conv_id, count(*) as n,
         coalesce(string_agg(c::varchar, ',' order by c) filter (where len(p) = d), '') as ends
  from points group by all
),
kids as (select node[1:d - 1] as node, d - 1 as d, count(*) as n_children from nodes where d > 0 group by all),
known as (select nodes.*, coalesce(n_children, 0) as n_children from nodes left join kids using (node, d)),
above as (
  select node[1:e] as node, e as d, (n_children = 0)::bigint as leaf, case when d > 0 then (n - 1) * length(node[d].t) else 0 end as saved
  from (select *, unnest(range(0, d + 1)) as e from known)
),
sums as (select node, d, sum(leaf)::bigint as n_leaves, sum(saved)::bigint as saved_tokens from above group by all)
select k.conv_id, k.d::bigint as depth, up.conv_id as parent_conv_id, k.n as n_convs, k.n_children, n_leaves, saved_tokens, sha256(k.ends) as ends_sha256
from known k join sums using (node, d) left join known up on k.d > 0 and up.d = k.d - 1 and up.node = k.node[1:k.d - 1]
"""
