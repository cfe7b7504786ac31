"""Dedup, quality, validation and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.arrays import laplacian_variance, percent, sign_hash
from sluice.functions.signatures import text_signatures
from sluice.operators import report
from sluice.operators.dedup import content_key, first_by_key, hamming_pairs, near_dup_greedy, ordered_union_distinct
from sluice.operators.quality import Thresholds, cascade, compose, heuristics, large_enough, sharp, similarity
from sluice.plans.registry import query
from sluice.session import checkpointed, table

MIN_CHARS, SHARP, TEXT_DISTANCE, VECTOR_DISTANCE = 200, 0.3, 8, 18

_SIGN_HASH = """
    sign as (
      select vec_id, e, (list_sort(e)[32] + list_sort(e)[33]) / 2 as m
      from (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings)),
    bits as (
      select vec_id, list_transform(list_transform(range(1, 65), lambda i: case when e[i] > m then 1 else 0 end), lambda b: b) as b from sign),
    hashed as (
      select vec_id,
        list_sum(list_transform(range(2, 65), lambda i: case when b[i] = 1 then (1::hugeint << (64 - i)::int) else 0::hugeint end))
        - case when b[1] = 1 then 9223372036854775808::hugeint else 0::hugeint end as h
      from bits)"""

_SIGNATURE = """
    token as (
      select doc_id, unnest(list_distinct(list_filter(string_split_regex(lower(text), '[^a-z0-9]+'), lambda t: t <> ''))) as t from documents),
    hash as (select doc_id, ('0x' || left(md5(t), 15))::bigint as h from token),
    bit as (select doc_id, i, sum(case when (h >> i) & 1 = 1 then 1 else -1 end) as v from hash, (select unnest(range(60))::int as i) group by doc_id, i),
    sig as (select doc_id, sum(case when v > 0 then 1::bigint << i else 0 end)::bigint as h from bit group by doc_id)"""


def _greedy(source: str, key: str, distance: int) -> str:
    """Sequential selection with the kept hashes as the state."""
    return f"""
    o as materialized (select {key} as id, h, row_number() over (order by {key}) as rn from {source}),
    r(rn, ids, ks) as (
      select 0::bigint, []::bigint[], []::bigint[]
      union all
      select o.rn, case when dup then ids else list_append(ids, o.id) end, case when dup then ks else list_append(ks, o.h) end
      from (select r.*, o.rn as rn2, len(list_filter(r.ks, lambda k: bit_count(xor(k, o.h)) <= {distance})) > 0 as dup
            from r join o on o.rn = r.rn + 1) x join o on o.rn = x.rn2),
    kept as (select unnest(ids) as id from r where rn = (select count(*) from o))
    select o.id, case when k.id is null then 'duplicate' else 'kept' end as fate from o left join kept k on o.id = k.id"""


def vector_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select("vec_id", sign_hash("embedding").alias("h"))


def signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_signatures(table(spark, sf_dir, "documents"))


@query(
    "exact_dedup_first",
    "select min(doc_id) as doc_id, md5(text) as digest, count(*) as copies from documents group by md5(text)",
)
def exact_dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = content_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "text")
    return first_by_key(docs, "digest", "doc_id", "copies")


@query("block_sign_hash", f"with {_SIGN_HASH} select vec_id, h::bigint as h from hashed")
def block_sign_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_hashes(spark, sf_dir)


@query("text_signature", f"with {_SIGNATURE} select doc_id, h from sig")
def text_signature_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signatures(spark, sf_dir)


@query(
    "hamming_pairs",
    f"""with {_SIGNATURE} select x.doc_id as a, y.doc_id as b, bit_count(xor(x.h, y.h))::int as distance
    from sig x join sig y on x.doc_id < y.doc_id where bit_count(xor(x.h, y.h)) <= {TEXT_DISTANCE}""",
)
def hamming_pairs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming_pairs(checkpointed(signatures(spark, sf_dir)), TEXT_DISTANCE, "doc_id", "h", 60)


@query("near_dup_greedy", f"with recursive {_SIGNATURE}, {_greedy('sig', 'doc_id', TEXT_DISTANCE)}")
def near_dup_greedy_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup_greedy(checkpointed(signatures(spark, sf_dir)), TEXT_DISTANCE, "doc_id", "h", 60)


@query("near_dup_greedy_vectors", f"with recursive {_SIGN_HASH}, h64 as (select vec_id, h::bigint as h from hashed), {_greedy('h64', 'vec_id', VECTOR_DISTANCE)}")
def near_dup_greedy_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup_greedy(vector_hashes(spark, sf_dir), VECTOR_DISTANCE, "vec_id", "h")


@query(
    "ordered_union_distinct",
    """with u as (
      select md5(text) as digest, 0 as part, doc_id from documents where source = 'src3' union all
      select md5(text), 1, doc_id from documents where source = 'src1' union all
      select md5(text), 2, doc_id from documents where source is null or source not in ('src1', 'src3')),
    f as (select *, row_number() over (partition by digest order by part, doc_id) as n from u)
    select digest, doc_id from f where n = 1""",
)
def ordered_union_distinct_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.md5("text").alias("digest"), "doc_id", "source")
    parts = [docs.where("source = 'src3'"), docs.where("source = 'src1'"), docs.where("source is null or source not in ('src1', 'src3')")]
    return ordered_union_distinct([p.select("digest", "doc_id") for p in parts], "digest", "doc_id").select("digest", "doc_id")


_NEIGHBOURS = """
    cell as (
      select vec_id, i, e[i + 1] as x,
        e[abs((i // 8) - 1) * 8 + i % 8 + 1] + e[(7 - abs(7 - ((i // 8) + 1))) * 8 + i % 8 + 1]
        + e[(i // 8) * 8 + abs(i % 8 - 1) + 1] + e[(i // 8) * 8 + 7 - abs(7 - (i % 8 + 1)) + 1] as around
      from (select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings), (select unnest(range(64)) as i)),
    var as (select vec_id, var_pop(around - 4 * x) as v from cell group by vec_id)"""


@query("sharpness_filter", f"with {_NEIGHBOURS} select vec_id, round(v, 6) as lap_var, v >= {SHARP} as is_sharp from var")
def sharpness_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "embeddings").select("vec_id", laplacian_variance("embedding", 8).alias("v"))
    return found.select("vec_id", F.round("v", 6).alias("lap_var"), sharp("v", SHARP).alias("is_sharp"))


_PROFILE = """
    p as (
      select doc_id, length(text)::int as width, 1 + length(text) - length(replace(text, chr(10), '')) as height,
        length(regexp_replace(text, '[^aeiou]', '', 'g')) / greatest(length(text), 1) as blue,
        length(regexp_replace(text, '[^.,;:!?]', '', 'g')) / greatest(length(text), 1) as edges from documents)"""
CASCADE = Thresholds(min_width=200, min_height=2, max_aspect=400.0, min_blue=0.2, max_blue=0.95, min_edges=0.01)


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as if they were pictures: characters across, lines down, vowels blue, punctuation edges."""
    n = F.char_length("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        n.cast("int").alias("width"),
        (1 + n - F.char_length(F.replace("text", F.lit("\n"), F.lit("")))).cast("long").alias("height"),
        (F.char_length(F.regexp_replace("text", "[^aeiou]", "")) / F.greatest(n, F.lit(1))).alias("blue"),
        (F.char_length(F.regexp_replace("text", "[^.,;:!?]", "")) / F.greatest(n, F.lit(1))).alias("edges"),
    )


@query(
    "heuristic_cascade",
    f"""with {_PROFILE},
    f as (select *, case when width is null or height is null or least(width, height) <= 0 then 'readable'
        when not (width >= {CASCADE.min_width} and height >= {CASCADE.min_height}) then 'size'
        when greatest(width, height) / least(width, height) > {CASCADE.max_aspect} then 'aspect'
        when not blue between {CASCADE.min_blue} and {CASCADE.max_blue} then 'blue'
        when edges < {CASCADE.min_edges} then 'edges' end as failed_check from p)
    select doc_id, failed_check, round(case when failed_check in ('readable', 'size') then null else greatest(width, height) / least(width, height) end, 6) as aspect_ratio,
      round(case when failed_check in ('readable', 'size', 'aspect') then null else blue end, 6) as blue_ratio,
      round(case when failed_check in ('readable', 'size', 'aspect', 'blue') then null else edges end, 6) as edge_density from f""",
)
def heuristic_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = heuristics(profiles(spark, sf_dir), CASCADE)
    return found.select("doc_id", "failed_check", *(F.round(c, 6).alias(c) for c in ("aspect_ratio", "blue_ratio", "edge_density")))


@query(
    "similarity_validate",
    """with e as (select vec_id, label, i, embedding[i + 1]::double as x from embeddings, (select unnest(range(64)) as i)),
    c as (select label, i, avg(x) as m from e group by label, i),
    l as (select e.vec_id, c.label, sum(e.x * c.m) * 20 as logit from e join c on e.i = c.i group by e.vec_id, c.label),
    s as (select vec_id, label, exp(logit - max(logit) over w) / sum(exp(logit)) over w * exp(max(logit) over w) as p from l window w as (partition by vec_id)),
    k as (select vec_id, max(p) as best, avg(p) as mean from s where label < 6 group by vec_id)
    select vec_id, round(best, 6) as max_prob, round(mean, 6) as avg_prob, best >= 0.25 as similar from k""",
)
def similarity_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels' mean vectors are the prompts: the first six the keywords, the others the anchors."""
    vectors = table(spark, sf_dir, "embeddings")
    means = vectors.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    prompts = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("vector"))
    from sluice.operators.quality import similarity_logits

    found = similarity_logits(vectors.select("vec_id", "embedding"), prompts, prompt_order="label", scale=20.0)
    scored = similarity(found.withColumn("n_keywords", F.lit(6)))
    return scored.select("vec_id", F.round("max_prob", 6).alias("max_prob"), F.round("avg_prob", 6).alias("avg_prob"), "similar")


@query(
    "composite_validate",
    f"""with {_PROFILE}, v as (
      select p.doc_id, case when not coalesce(width >= 200 and height >= 2, false) then 'size' when not coalesce(quality = 1, false) then 'quality' end as rejected_by
      from p left join labels l using (doc_id))
    select count(*) filter (where rejected_by is null) as valid, count(*) filter (where rejected_by is not null) as invalid, count(*) as total,
      round(count(*) filter (where rejected_by is null) / count(*) * 100, 6) as rate from v""",
)
def composite_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    found = profiles(spark, sf_dir).select("doc_id", large_enough("width", "height", 200, 2).alias("large"))
    joined = found.join(labels, "doc_id", "left").withColumn("good", F.col("quality") == 1)
    rate = report.pass_rate(compose(joined, [("size", "large"), ("quality", "good")]))
    return rate.select("valid", "invalid", "total", F.round("rate", 6).alias("rate"))


QUERY_FATES = f"""
    d as (
      select doc_id, n_chars, quality, text, min(doc_id) over (partition by md5(text)) as first_id
      from documents left join labels using (doc_id)),
    fates as (
      select doc_id, case when n_chars < {MIN_CHARS} then 'low_res' when quality = 0 then 'invalid'
             when doc_id <> first_id then 'duplicate' else 'kept' end as fate from d)"""


def fates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", F.md5("text").alias("digest"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    firsts = first_by_key(docs.select("doc_id", "digest"), "digest", "doc_id").withColumnRenamed("doc_id", "first_id")
    joined = docs.join(firsts, "digest").join(labels, "doc_id", "left")
    checks = [
        ("low_res", large_enough("n_chars", "n_chars", MIN_CHARS, MIN_CHARS), {}),
        ("invalid", F.coalesce(F.col("quality") != 0, F.lit(True)), {}),
        ("duplicate", F.col("doc_id") == F.col("first_id"), {}),
    ]
    return cascade(joined, checks).select("doc_id", F.coalesce("failed_check", F.lit("kept")).alias("fate"))


@query("clean_pipeline", f"with {QUERY_FATES} select fate, count(*) as n from fates group by fate")
def clean_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fates(spark, sf_dir).groupBy("fate").agg(F.count(F.lit(1)).alias("n"))


@query(
    "funnel_report",
    f"""with {QUERY_FATES}, c as (
      select count(*) as total, count(*) filter (where fate <> 'low_res') as processed, count(*) filter (where fate = 'low_res') as removed_low_res,
        0::bigint as removed_blur, count(*) filter (where fate = 'duplicate') as removed_duplicates,
        count(*) filter (where fate = 'invalid') as removed_validation, count(*) filter (where fate = 'kept') as final from fates)
    select 'images' as section, metric, value from (unpivot c on columns(*) into name metric value value)""",
)
def funnel_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.long_form(report.image_funnel(fates(spark, sf_dir)), "images")


@query(
    "combined_totals",
    f"""with {QUERY_FATES}, c as (select count(*) as n, count(*) filter (where fate = 'kept') as kept, count(*) filter (where fate in ('low_res', 'duplicate')) as gone from fates),
    v as (select count(distinct conv_id) as videos, count(*) as frames from conversations)
    select n + videos as total_input, kept + frames as total_output, gone as total_removed from c, v""",
)
def combined_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id")
    videos = report.video_counts(turns.distinct(), turns)
    return report.combined_totals(report.image_funnel(fates(spark, sf_dir)), videos)


@query(
    "progress_summary",
    """with s as (select case when quality is null then 'skipped' when quality = 1 then 'success' else 'failed' end as status from documents left join labels using (doc_id))
    select 2000::bigint as total, count(*) as processed, count(*) filter (where status = 'success') as success, count(*) filter (where status = 'failed') as failed,
      count(*) filter (where status = 'skipped') as skipped, count(*) / 2000 * 100 as progress_pct, count(*) filter (where status = 'failed') as error_count from s""",
)
def progress_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    status = F.when(F.col("quality").isNull(), "skipped").when(F.col("quality") == 1, "success").otherwise("failed")
    return report.progress(table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").select(status.alias("status")), 2000)


@query(
    "asset_inventory",
    """select source as directory, count(*) filter (where lang = 'en') as images, count(*) filter (where lang <> 'en') as videos,
      printf('%d imgs / %d vids', count(*) filter (where lang = 'en'), count(*) filter (where lang <> 'en')) as label from documents group by source""",
)
def asset_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "documents").select(F.col("source").alias("directory"), F.when(F.col("lang") == "en", "image").otherwise("video").alias("kind"))
    return report.inventory(kinds)


@query(
    "label_shares",
    "select source, count(*) as n, case when count(*) = 0 then 0 else count(quality) / count(*) * 100 end as pct from documents left join labels using (doc_id) group by source",
)
def label_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    counts = table(spark, sf_dir, "documents").select("doc_id", "source").join(labels, "doc_id", "left").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("quality").alias("k"))
    return counts.select("source", "n", percent("k", "n").alias("pct"))
