"""Scene changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.arrays import normalized
from sluice.operators.scenes import frame_names, scene_keyframes
from sluice.plans.registry import query
from sluice.session import table

CHANGE = 100.0


@query(
    "scene_keyframes",
    f"""with e as (select label, vec_id, i, embedding[i + 1]::double as x from embeddings, (select unnest(range(64)) as i)),
    l as (select *, lag(x) over (partition by label, i order by vec_id) as y from e),
    d as (select label, vec_id, case when count(y) = 0 then null else (1 - corr(x, y)) * 100 end as diff from l group by label, vec_id),
    k as (select *, diff is null or diff > {CHANGE} as is_key from d)
    select label, vec_id, round(diff, 6) as diff, is_key,
      case when is_key then sum(is_key::int) over (partition by label order by vec_id rows unbounded preceding) - 1 end::bigint as ordinal,
      case when is_key then printf('label%d_frame_%05d.jpg', label, (sum(is_key::int) over (partition by label order by vec_id rows unbounded preceding) - 1)::bigint) end as name from k""",
)
def scene_keyframes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of a label, in order of id, are a video's frames."""
    frames = table(spark, sf_dir, "embeddings").select("label", "vec_id", "embedding")
    found = scene_keyframes(frames, CHANGE, ["label"], "vec_id", "embedding").withColumn("stem", F.concat(F.lit("label"), F.col("label").cast("string")))
    named = frame_names(found, "stem").withColumn("name", F.when(F.col("is_key"), F.col("name")))
    return named.select("label", "vec_id", F.round("diff", 6).alias("diff"), "is_key", "ordinal", "name")


@query(
    "histogram_by_hour",
    """with b as (select date_trunc('hour', ts) as hour, count(*) filter (where event_type = 'click') as c1, count(*) filter (where event_type = 'view') as c2,
        count(*) filter (where event_type = 'purchase') as c3, count(*) filter (where event_type = 'signup') as c4, count(*) filter (where event_type = 'error') as c5 from events group by 1)
    select hour, round(c1 / n, 6) as click, round(c2 / n, 6) as view, round(c3 / n, 6) as purchase from (select *, sqrt(c1*c1 + c2*c2 + c3*c3 + c4*c4 + c5*c5) as n from b)""",
)
def histogram_by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = ("click", "view", "purchase", "signup", "error")
    counts = table(spark, sf_dir, "events").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
    bins = counts.agg(*(F.count_if(F.col("event_type") == k).alias(k) for k in kinds))
    unit = bins.select("hour", normalized(F.array(*kinds)).alias("h"))
    return unit.select("hour", *(F.round(F.get("h", F.lit(k)), 6).alias(n) for k, n in enumerate(kinds[:3])))
