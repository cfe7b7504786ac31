"""Quotas, pages, resumption, rates."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import acquire, rate
from sluice.operators.order import ranked
from sluice.plans.registry import query
from sluice.session import table

MOST = 100
#: Every source of documents stands for one of pictures: by its number, in the registry's order.
NAMES = [s[0] for s in acquire.SOURCES]


@query(
    "source_quotas",
    """with s as (
      select source as name, dense_rank() over (order by count(*) desc, source) as priority, count(*) as hits from documents where source is not null group by source),
    w as (select *, 1 / (priority * 0.5::double + 0.5::double) as weight from s)
    select name, priority::int as priority, round(weight, 6) as weight, greatest(floor(hits_in_all * weight / sum(weight) over ()), floor(hits_in_all / count(*) over ()))::bigint as quota
    from w, (select count(*) // 2 as hits_in_all from documents)""",
)
def source_quotas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotas of half of all documents for their sources, the larger ones first."""
    docs = table(spark, sf_dir, "documents")
    sizes = docs.where("source is not null").groupBy(F.col("source").alias("name")).agg(F.count(F.lit(1)).alias("hits"))
    ordered = ranked(sizes.withColumn("_less", -F.col("hits")), [], ["_less", "name"], "priority").withColumn("priority", (F.col("priority") + 1).cast("int"))
    return acquire.quotas(ordered, docs.count() // 2).select("name", "priority", F.round("weight", 6).alias("weight"), "quota")


_HITS = """
    hits as (
      select lang as keyword, ['unsplash', 'pexels', 'flickr', 'wikimedia', 'nasa'][substr(source, 4)::int % 5 + 1] as source, doc_id as pos, md5(text) as url from documents),
    ranked as (select *, row_number() over (partition by keyword, source order by pos) as rank from hits)"""


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.get(F.array(*(F.lit(n) for n in NAMES)), F.substring("source", 4, 9).cast("int") % len(NAMES))
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.col("lang").alias("keyword"), name.alias("source"), F.col("doc_id").alias("pos"), F.md5("text").alias("url"))


def _allocation(order: list[tuple[str, int]], most: int) -> str:
    """The fold over the sources written out."""
    parts = []
    for k, (name, quota) in enumerate(order):
        before = " union all ".join(f"select keyword, url from t{j}" for j in range(k)) or "select null::varchar as keyword, null::varchar as url where false"
        parts.append(
            f"""p{k} as ({before}), n{k} as (select keyword, count(*) as n from p{k} group by keyword),
            t{k} as (select r.keyword, r.url, {k} as part, min(r.pos) as pos, '{name}' as source from ranked r left join n{k} n on r.keyword = n.keyword
              where r.source = '{name}' and r.rank <= least({quota}, {most} - coalesce(n.n, 0))
                and not exists (select 1 from p{k} p where p.keyword = r.keyword and p.url = r.url) group by r.keyword, r.url)"""
        )
    union = " union all ".join(f"select * from t{k}" for k in range(len(order)))
    return f"""with {_HITS}, {", ".join(parts)}, u as ({union})
    select keyword, source, pos, url, row_number() over (partition by keyword order by part, pos) - 1 as taken_pos from u"""


@query("source_quota_alloc", _allocation([("unsplash", 13), ("pexels", 9), ("nasa", 8), ("wikimedia", 8), ("flickr", 8)], 40))
def source_quota_alloc(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = acquire.enabled_sources(acquire.source_registry(spark).withColumn("has_key", F.lit(True)))
    return acquire.allocate(hits(spark, sf_dir), sources, 40)


@query("per_group_limit", "select source, doc_id from (select source, doc_id, row_number() over (partition by source order by n_chars desc, doc_id) as n from documents) where n <= 5")
def per_group_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("source", "doc_id", (-F.col("n_chars")).alias("shortness"))
    return acquire.per_group_limit(docs, "source", ["shortness", "doc_id"], 5).select("source", "doc_id")


@query("resume_anti_join", "select doc_id, source from documents where doc_id not in (select doc_id from labels where doc_id is not null)")
def resume_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return acquire.resume(table(spark, sf_dir, "documents").select("doc_id", "source"), table(spark, sf_dir, "labels"), "doc_id")


@query(
    "page_plan",
    """with t as (select source as keyword, count(*) as total from documents group by source),
    p as (select keyword, least(ceil(total / 30), 4)::int as pages from t)
    select keyword, unnest(range(1, pages + 1))::int as page, 30 as page_rows from p""",
)
def page_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = table(spark, sf_dir, "documents").groupBy(F.col("source").alias("keyword")).agg(F.count(F.lit(1)).alias("total"))
    return acquire.page_plan(totals, 30, 100)


@query(
    "retry_schedule",
    """with t as (select event_id, user_id, ts, row_number() over (partition by user_id order by ts, event_id) - 1 as attempt from events where event_type = 'error')
    select event_id, attempt::int as attempt, case when attempt >= 4 then 0.0 else 2.0 * pow(2, attempt) end::double as wait from t""",
)
def retry_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every error of a user is a failed attempt; the waits of five attempts."""
    failed = ranked(table(spark, sf_dir, "events").where("event_type = 'error'").select("event_id", "user_id", "ts"), ["user_id"], ["ts", "event_id"], "attempt")
    return failed.select("event_id", F.col("attempt").cast("int").alias("attempt"), acquire.backoff_wait("attempt", 5, 2.0).alias("wait"))


@query(
    "ordered_names",
    "select doc_id, printf('%s_%05d.jpg', source, row_number() over (partition by source order by doc_id) - 1) as name from documents",
)
def ordered_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sluice.functions.text import numbered_name
    from sluice.operators.dedup import numbered_firsts

    docs = numbered_firsts(table(spark, sf_dir, "documents").select("doc_id", "source"), "source", "doc_id")
    return docs.select("doc_id", numbered_name("source", (F.col("occurrence") - 1).cast("int"), ".jpg").alias("name"))


@query(
    "rate_window",
    """select event_id, count(*) over (partition by event_type order by ts range between interval '3599.999999 seconds' preceding and current row) as in_window from events""",
)
def rate_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate.window_counts(table(spark, sf_dir, "events").select("event_id", "event_type", "ts"), "event_type").select("event_id", "in_window")


def _now(spark: SparkSession, sf_dir: str) -> datetime.datetime:
    return table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]


@query(
    "source_status",
    """with n as (select max(ts) as now from events),
    u as (select event_type, count(*) as used from events, n where now - ts < interval '1 hour' and now - ts >= interval '0 seconds' group by event_type),
    l(event_type, lim) as (values ('click', 50), ('view', 5), ('purchase', 0), ('signup', 100))
    select t.event_type as source, t.event_type <> 'error' and t.event_type <> 'signup' as enabled, t.priority,
      case when lim > 0 then greatest(0, lim - coalesce(used, 0)) end::bigint as remaining
    from (values ('click', 1), ('view', 2), ('purchase', 3), ('signup', 99), ('error', 99)) t(event_type, priority) left join l using (event_type) left join u using (event_type)""",
)
def source_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = spark.createDataFrame([(n, p) for p, n in enumerate(("click", "view", "purchase", "signup", "error"))], "name string, priority int")
    config = spark.createDataFrame([("click", 1), ("view", 2), ("purchase", 3)], "name string, priority int")
    sources = acquire.configured(registry, config)
    limits = spark.createDataFrame([("click", 50), ("view", 5), ("purchase", 0), ("signup", 100)], "event_type string, limit int")
    left = rate.remaining(table(spark, sf_dir, "events").select("event_type", "ts"), limits, _now(spark, sf_dir), "event_type")
    return acquire.source_status(sources, sources.where("name not in ('error', 'signup')"), left.withColumnRenamed("event_type", "name"))


@query(
    "rate_oldest",
    """with n as (select max(ts) as now from events) select event_type, min(ts) as oldest from events, n where now - ts < interval '1 hour' group by event_type""",
)
def rate_oldest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate.oldest_in_window(table(spark, sf_dir, "events").select("event_type", "ts"), _now(spark, sf_dir), "event_type")


@query(
    "rate_admission",
    """with recursive e as materialized (select event_type, event_id, epoch_us(ts) as us, row_number() over (partition by event_type order by ts, event_id) as n from events),
    r(event_type, n, event_id, us, admitted, q) as (
      select event_type, n, event_id, us, us, [us] from e where n = 1
      union all
      select e.event_type, e.n, e.event_id, e.us, greatest(e.us, case when len(r.q) >= 2 then r.q[1] + 3600000000 else e.us end),
        list_append(case when len(r.q) >= 2 then r.q[2:] else r.q end, greatest(e.us, case when len(r.q) >= 2 then r.q[1] + 3600000000 else e.us end))
      from r join e on e.event_type = r.event_type and e.n = r.n + 1)
    select event_type, event_id, us as arrived_us, admitted as admitted_us, admitted - us as waited_us from r""",
)
def rate_admission(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate.admissions(table(spark, sf_dir, "events").select("event_type", "event_id", "ts"), 2, "event_type")


@query(
    "proxy_pool",
    """with p as (select distinct source as proxy from documents), f as (select distinct source as proxy from documents where lang = 'es' and n_chars > 9000)
    select proxy from p where proxy not in (select proxy from f) union all select proxy from p where not exists (select 1 from p where proxy not in (select proxy from f))""",
)
def proxy_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    failed = docs.where("lang = 'es' and n_chars > 9000").select(F.col("source").alias("proxy")).distinct()
    return acquire.available_proxies(docs.select(F.col("source").alias("proxy")).distinct(), failed)
