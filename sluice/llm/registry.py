"""The queries of this subpackage over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sluice.session import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.substring_dedup import dedup_substrings

    return dedup_substrings(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.line_dedup import dedup_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return dedup_lines(docs).select("doc_id", "text", "n_dropped")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.byte_bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.secrets import digest_of_secrets

    return digest_of_secrets(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.near_vectors import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.95)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.toxicity import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.shingle_join import jaccard_groups

    return jaccard_groups(table(spark, sf_dir, "documents"), width=3, percent=90)


def op9_maxscore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.topk import search

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 50 = 0"), k=5, scale=256)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.html_extract import extract

    return extract(table(spark, sf_dir, "pages"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.fingerprints import edited_likeness

    return edited_likeness(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.spelling import spelling_variants

    return spelling_variants(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


_REACH = """
    reach(id, root) as (select id, id from node union select link.b, reach.root from reach join link on reach.id = link.a),
    least as (select id, min(root) as component_id from reach group by id)"""

NEAR_VECTORS = f"""
    with recursive v as (select vec_id as id, list_transform(embedding, lambda x: x::double) as e from embeddings),
    node as (select id, e, sqrt(list_inner_product(e, e)) as norm from v),
    link as (select x.id as a, y.id as b from node x join node y on x.id <> y.id
      where x.norm > 0 and y.norm > 0 and list_inner_product(x.e, y.e) / (x.norm * y.norm) >= 0.95),
    {_REACH}
    select id as vec_id, (select count(*) from link where a = id) as n_links, component_id, id = component_id as kept from least"""

TOP_K = """
    with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings),
    s as (select q.vec_id as query_id, v.vec_id, list_inner_product(q.e, v.e)::bigint as score from v q join v on q.vec_id <> v.vec_id where q.vec_id % 50 = 0),
    r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
    select query_id, rank::int as rank, vec_id, score from r where rank <= 5"""

SHINGLE_JOIN = f"""
    with recursive w as (
      select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda t: t <> '') as ws
      from documents),
    shingle as materialized (
      select distinct doc_id as id, hash(array_to_string(ws[i : i + 2], ' ')) as s
      from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 2, least(len(ws), 1)) + 1)) as i from w)),
    node as (select doc_id as id, (select count(*) from shingle where shingle.id = doc_id) as n from documents),
    common as (select x.id as a, y.id as b, count(*) as c from shingle x join shingle y on x.s = y.s and x.id <> y.id group by x.id, y.id),
    link as (select a, b from common join node x on x.id = a join node y on y.id = b where 100 * c >= 90 * (x.n + y.n - c)),
    {_REACH}
    select id as doc_id, n as n_shingles, component_id from least join node using (id)"""


def oracle_sql() -> dict[str, str]:
    from sluice.llm import collocations, line_dedup, spelling

    return {
        "op2_line_dedup": line_dedup.oracle(),
        "op4_near_vectors": NEAR_VECTORS,
        "op8_shingle_join": SHINGLE_JOIN,
        "op9_maxscore_topk": TOP_K,
        "op12_spelling_variants": spelling.oracle(),
        "op13_collocations": collocations.oracle(),
    }
