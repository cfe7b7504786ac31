"""Planning of acquisition: sources, quotas, pages, names, resumption."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Name, place in the registry, needs a key, priority, requests an hour, results a page.
SOURCES = (
    ("unsplash", 0, True, 1, 50, 30),
    ("pexels", 1, True, 2, 200, 80),
    ("flickr", 2, True, 5, 3600, 100),
    ("wikimedia", 3, False, 4, 500, 50),
    ("nasa", 4, False, 3, 0, 30),
)
LAST_PRIORITY = 99


def source_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(*s[:2], True, s[2], False, *s[3:]) for s in SOURCES],
        "name string, registry_pos int, enabled boolean, needs_key boolean, has_key boolean, priority int, rate_limit int, page_size int",
    )


def enabled_sources(sources: DataFrame, requested: list[str] | None = None) -> DataFrame:
    """Requested (none means all), enabled, and with a key where one is needed; in order of priority, then of registry."""
    out = sources.where("enabled and (has_key or not needs_key)")
    if requested:
        out = out.where(F.col("name").isin(*requested))
    return out.withColumn("priority", F.coalesce("priority", F.lit(LAST_PRIORITY))).orderBy("priority", "registry_pos")


def configured(registry: DataFrame, config: DataFrame) -> DataFrame:
    """The registry with its configuration's priorities; without one a source comes last."""
    return registry.drop("priority").join(config.select("name", "priority"), "name", "left").withColumn("priority", F.coalesce("priority", F.lit(LAST_PRIORITY)))


def weight(priority: Column) -> Column:
    return 1 / (priority * 0.5 + 0.5)


def quotas(sources: DataFrame, most: int) -> DataFrame:
    """The sources with weight and quota: their share of ``most`` by weight, rounded down, and no less than an equal share."""
    every = Window.partitionBy()
    out = sources.withColumn("weight", weight(F.col("priority")))
    share = F.floor(most * F.col("weight") / F.sum("weight").over(every))
    return out.withColumn("quota", F.greatest(share, F.floor(F.lit(most) / F.count(F.lit(1)).over(every))).cast("long"))


def allocate(hits: DataFrame, sources: DataFrame, most: int, keyword: str = "keyword", url: str = "url") -> DataFrame:
    """The hits (keyword, source, pos, url) that are taken, with ``taken_pos``, their place among a keyword's from 0.

    Sources take in order of priority what their quota and the rest of ``most``
    allow; URLs that came before are dropped after that cut and leave their
    places to later sources only. A source's hits of a keyword are cut to its
    quota before anything is gathered, so what is folded for a keyword, in one
    array by one expression, has no more entries than all quotas together.
    """
    plan = {r["name"]: (k, min(r["quota"], most)) for k, r in enumerate(quotas(sources, most).orderBy("priority", "registry_pos").collect())}
    if not plan:
        return hits.limit(0).withColumn("taken_pos", F.lit(0).cast("long"))
    of_source = lambda at: F.try_element_at(F.create_map(*(F.lit(x) for name, found in plan.items() for x in (name, found[at]))), F.col("source"))
    rank = F.row_number().over(Window.partitionBy(keyword, "source").orderBy("pos"))
    # the largest quota is a number, which limits each task's rows before they are dealt
    largest = max(quota for _, quota in plan.values())
    cut = hits.withColumn("_order", of_source(0)).where("_order is not null").withColumn("_rank", rank).where(F.col("_rank") <= largest).where(F.col("_rank") <= of_source(1))
    rest = [c for c in hits.columns if c != keyword]
    listed = cut.groupBy(keyword).agg(F.array_sort(F.collect_list(F.struct("_order", "_rank", *rest))).alias("_hits"))
    element = cut.select(F.struct("_order", "_rank", *rest).alias("x")).schema["x"].dataType
    start = F.struct(F.array().cast(T.ArrayType(element)).alias("taken"), F.lit(-1).alias("order"), F.lit(0).alias("before"))

    def step(state, hit):
        before = F.when(state["order"] == hit["_order"], state["before"]).otherwise(F.size(state["taken"]))
        fits = (hit["_rank"] <= most - before) & ~F.coalesce(F.exists(state["taken"], lambda t: t[url] == hit[url]), F.lit(False))
        return F.struct(F.when(fits, F.concat(state["taken"], F.array(hit))).otherwise(state["taken"]).alias("taken"), hit["_order"].alias("order"), before.alias("before"))

    folded = listed.select(keyword, F.posexplode(F.aggregate("_hits", start, step, lambda state: state["taken"])).alias("taken_pos", "_hit"))
    return folded.select(*(F.col(keyword) if c == keyword else F.col("_hit")[c].alias(c) for c in hits.columns), F.col("taken_pos").cast("long").alias("taken_pos"))


def per_group_limit(df: DataFrame, key: str, order: list[str], most: int) -> DataFrame:
    """At most so many rows of each key; planned with a limit before the shuffle."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_rank") <= most).drop("_rank")


def first_of(df: DataFrame, order: list[str], most: int) -> DataFrame:
    """The first rows in an order: each task keeps that many, the last one merges them."""
    return df.orderBy(*order).limit(most)


def page_plan(totals: DataFrame, page_size: int, most: int, key: str = "keyword", total: str = "total") -> DataFrame:
    """(key, page, page_rows): the pages to ask for; an unknown total of 0 means as many as ``most`` may need."""
    size = min(page_size, most)
    wanted = -(-most // size)
    pages = F.when(F.col(total) > 0, F.least(F.ceil(F.col(total) / size), F.lit(wanted))).otherwise(F.lit(wanted))
    return totals.select(key, F.explode(F.sequence(F.lit(1), pages.cast("int"))).alias("page"), F.lit(size).alias("page_rows"))


def resume(items: DataFrame, completed: DataFrame, item: str = "item_id") -> DataFrame:
    """The items that aren't completed yet; a null item never is."""
    return items.join(completed.select(item), item, "left_anti")


def assets(hits: DataFrame, keyword: str = "keyword", url: str = "url", order: str = "taken_pos") -> DataFrame:
    """Hits with the directory and name their file gets: the source by URL and the place as a number."""
    from sluice.functions.text import keyword_dir, source_of_url, url_extension

    ending = F.coalesce(url_extension(url), F.lit(".jpg"))
    name = F.concat(source_of_url(url), F.lit("_"), F.lpad(F.col(order).cast("string"), 5, "0"), ending)
    return hits.select("*", keyword_dir(keyword).alias("directory"), name.alias("name"))


def source_status(registry: DataFrame, enabled: DataFrame, remaining: DataFrame) -> DataFrame:
    """Every source with whether it is enabled and its remaining requests, null where there is no count."""
    return (
        registry.select("name", "priority")
        .join(enabled.select("name", F.lit(True).alias("on")), "name", "left")
        .join(remaining.select("name", "remaining"), "name", "left")
        .select(F.col("name").alias("source"), F.coalesce("on", F.lit(False)).alias("enabled"), "priority", "remaining")
    )


def lookup(df: DataFrame, key: str, pairs: dict[str, str], default: str, name: str = "value") -> DataFrame:
    """A dictionary's value for a column's key, or the default."""
    table = F.create_map(*(F.lit(x) for pair in pairs.items() for x in pair))
    return df.withColumn(name, F.coalesce(F.try_element_at(table, F.col(key)), F.lit(default)))


def available_proxies(proxies: DataFrame, failed: DataFrame, url: str = "proxy") -> DataFrame:
    """The proxies that haven't failed; all of them if every one has."""
    rest = proxies.join(failed.select(url), url, "left_anti")
    none = rest.limit(1).agg((F.count(F.lit(1)) == 0).alias("_none"))
    return rest.unionByName(proxies.join(F.broadcast(none.where("_none")), how="cross").drop("_none"))


def pick_proxy(proxies: DataFrame, failed: DataFrame, seed: int, url: str = "proxy") -> DataFrame:
    """One of the available proxies, by chance: the least by a hash with the seed, so a task that runs again picks the same."""
    return available_proxies(proxies, failed, url).orderBy(F.xxhash64(F.lit(seed), F.col(url)), url).limit(1)


def mark_failed(failed: DataFrame, proxies: DataFrame, marked: DataFrame, url: str = "proxy") -> DataFrame:
    """The failed proxies with those that are marked now; none once all have failed, which starts them over."""
    every = failed.select(url).union(marked.select(url)).distinct().join(proxies.select(url), url, "left_semi")
    left = proxies.select(url).distinct().join(every, url, "left_anti").limit(1).count()
    return every if left else every.limit(0)


def backoff_wait(attempt: Column | str, attempts: int, delay: float, jitter: Column | float = 0.0) -> Column:
    """Seconds to wait after an attempt, counted from 0: doubling, with a part by chance; none after the last."""
    at = F.col(attempt) if isinstance(attempt, str) else attempt
    wait = F.lit(float(delay)) * F.pow(F.lit(2.0), at) + (jitter if isinstance(jitter, Column) else F.lit(float(jitter)))
    return F.when(at >= attempts - 1, F.lit(0.0)).otherwise(wait)


def backoff(spark: SparkSession, attempts: int, delay: float, jitter: float = 0.0, seed: int = 0) -> DataFrame:
    """(attempt, wait) before each retry: doubling, with a random part; no wait after the last attempt."""
    return spark.range(attempts).select(F.col("id").cast("int").alias("attempt")).withColumn("wait", backoff_wait("attempt", attempts, delay, F.rand(seed) * jitter))
