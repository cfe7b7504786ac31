"""String and extraction queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import text as T
from sluice.operators.acquire import lookup
from sluice.plans.registry import query
from sluice.session import table
from sluice.sources.web import links


@query(
    "keyword_dir",
    r"""select doc_id, replace(regexp_replace(regexp_replace(text, '[<>:"/\\|?*]', '', 'g'), '^[\s]+|[\s]+$', '', 'g'), ' ', '_') as dir from documents""",
)
def keyword_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.keyword_dir("text").alias("dir"))


_URLS = "(select page_id, case page_id % 5 when 0 then url || '.JPG' when 1 then url || '_th.png?x=1' when 2 then url || '_med.webp' when 3 then url || '/flickr/a.gif' else url end as url from pages)"


def image_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page addresses with endings as pictures have them."""
    kind = F.col("page_id") % 5
    url = (
        F.when(kind == 0, F.concat("url", F.lit(".JPG")))
        .when(kind == 1, F.concat("url", F.lit("_th.png?x=1")))
        .when(kind == 2, F.concat("url", F.lit("_med.webp")))
        .when(kind == 3, F.concat("url", F.lit("/flickr/a.gif")))
        .otherwise(F.col("url"))
    )
    return table(spark, sf_dir, "pages").select("page_id", url.alias("url"))


@query(
    "url_extension",
    rf"""with e as (select page_id, lower(regexp_extract(split_part(url, '?', 1), '[^/]\.([^./]+)$', 1)) as s from {_URLS})
    select page_id, case when s in ('jpg', 'jpeg', 'png', 'webp', 'bmp', 'gif') then '.' || s end as extension from e""",
)
def url_extension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_urls(spark, sf_dir).select("page_id", T.url_extension("url").alias("extension"))


@query(
    "source_from_url",
    f"""select page_id, case when contains(lower(url), 'unsplash') then 'unsplash' when contains(lower(url), 'pexels') then 'pexels' when contains(lower(url), 'flickr') then 'flickr'
      when contains(lower(url), 'wikimedia') or contains(lower(url), 'wikipedia') then 'wikimedia'
      when contains(lower(url), 'nasa') or contains(lower(url), 'earthobservatory') then 'nasa' else 'unknown' end as source from {_URLS}""",
)
def source_from_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_urls(spark, sf_dir).select("page_id", T.source_of_url("url").alias("source"))


@query(
    "large_variant",
    f"""select page_id, case when contains(url, '_th.') then replace(url, '_th.', '_lrg.') when contains(url, '_thumb.') then replace(url, '_thumb.', '_lrg.')
      when contains(url, '_med.') then replace(url, '_med.', '_lrg.') when contains(url, '_small.') then replace(url, '_small.', '_lrg.') else url end as url from {_URLS}""",
)
def large_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return image_urls(spark, sf_dir).select("page_id", T.large_variant("url").alias("url"))


@query(
    "mime_lookup",
    "select event_id, case event_type when 'click' then '.jpg' when 'view' then '.png' end as extension from events",
)
def mime_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    mime = F.when(F.col("event_type") == "click", "IMAGE/JPEG").when(F.col("event_type") == "view", "image/png").otherwise("image/png; charset=x")
    return table(spark, sf_dir, "events").select("event_id", T.mime_extension(mime).alias("extension"))


@query(
    "lookup_default",
    "select event_id, coalesce(map {'click': 'c', 'view': 'v', 'purchase': 'p'}[event_type], 'Unknown') as code from events",
)
def lookup_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", {"click": "c", "view": "v", "purchase": "p"}, "Unknown", "code")
    return found.select("event_id", "code")


@query(
    "extract_links",
    r"""with h as (select page_id, list_distinct(regexp_extract_all(html, '<a\b[^>]*?\shref="([^"]*)"', 1)) as l from pages), u as (select page_id, unnest(l) as href from h)
    select page_id, case when starts_with(href, 'http') then href else 'https://example.org' || href end as url from u""",
)
def extract_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(table(spark, sf_dir, "pages"), "https://example.org").select("page_id", "url")


@query(
    "html_title",
    r"""select page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') as title, length(regexp_extract(html, '(?s)<article>(.*?)</article>', 1)) as article_chars from pages""",
)
def html_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.nullif(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit("")).alias("title"),
        F.char_length(F.regexp_extract("html", "(?s)<article>(.*?)</article>", 1)).cast("long").alias("article_chars"),
    )


@query("json_props", "select event_type, sum((props->>'k')::bigint)::bigint as total, count(*) as n from events group by event_type")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k bigint").getField("k").alias("k"))
    return parsed.groupBy("event_type").agg(F.sum("k").alias("total"), F.count(F.lit(1)).alias("n"))


@query(
    "prompt_batch",
    r"""with l as (select conv_id, turn, unnest(list_filter(list_transform(string_split_regex(text, '\r\n|\r|\n'), lambda s: regexp_replace(s, '^[\s]+|[\s]+$', '', 'g')), lambda s: s <> '')) as line,
        generate_subscripts(list_filter(list_transform(string_split_regex(text, '\r\n|\r|\n'), lambda s: regexp_replace(s, '^[\s]+|[\s]+$', '', 'g')), lambda s: s <> ''), 1) - 1 as idx
      from conversations)
    select conv_id, turn, idx::int as idx, line || ', photorealistic, 1080p, high quality, detailed' as prompt, printf('synthetic_%05d.png', idx) as name from l""",
)
def prompt_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.posexplode(T.prompt_lines("text")).alias("idx", "line"))
    return lines.select("conv_id", "turn", "idx", T.enhanced_prompt("line").alias("prompt"), T.numbered_name(F.lit("synthetic"), "idx", ".png").alias("name"))


@query(
    "keyword_lists",
    r"""select conv_id, turn, len(list_filter(list_transform(string_split(text, ','), lambda s: regexp_replace(s, '^[\s]+|[\s]+$', '', 'g')), lambda s: s <> ''))::int as n from conversations""",
)
def keyword_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.size(T.keyword_list("text")).alias("n"))


@query(
    "first_filled_fields",
    """select doc_id, coalesce(nullif(case when lang = 'en' then '' else lang end, ''), nullif(source, '')) as field,
      nullif(left(case when n_chars < 300 then '' else text end, 100), '') as excerpt from documents""",
)
def first_filled_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lang = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    text = F.when(F.col("n_chars") < 300, "").otherwise(F.col("text"))
    return docs.select("doc_id", T.first_filled(lang, "source").alias("field"), T.truncated(text, 100).alias("excerpt"))


@query(
    "photo_urls",
    "select c_custkey, case when c_nationkey % 4 <> 0 then 'https://live.staticflickr.com/' || c_nationkey || '/' || c_custkey || '_' || c_mktsegment || '_b.jpg' end as url from customer",
)
def photo_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    server = F.when(F.col("c_nationkey") % 4 == 0, "").otherwise(F.col("c_nationkey").cast("string"))
    return table(spark, sf_dir, "customer").select("c_custkey", T.photo_url(server, F.col("c_custkey").cast("string"), "c_mktsegment").alias("url"))


_LEVELS = {"click": "INFO", "view": "DEBUG", "purchase": "SUCCESS", "signup": "WARNING", "error": "ERROR"}
_LEVEL_CASE = "case event_type " + " ".join(f"when '{k}' then '{v}'" for k, v in _LEVELS.items()) + " else 'TRACE' end"


@query(
    "log_lines",
    f"""with l as (select event_id, ts, {_LEVEL_CASE} as level from events), n as (select max(ts) as now from events),
    t as (select *, strftime(ts, '%H:%M:%S') || ' | ' || rpad(level, 8, ' ') || ' | event ' || event_id as line,
      case level when 'INFO' then 'cyan' when 'DEBUG' then 'dim' when 'SUCCESS' then 'green' when 'WARNING' then 'yellow' when 'ERROR' then 'red' end as style from l)
    select event_id, case when style is null then line else '[' || style || ']' || line || '[/' || style || ']' end as line,
      ts >= now - interval '7 days' and level <> 'TRACE' as in_log, ts >= now - interval '30 days' and level = 'ERROR' as in_errors from t, n""",
)
def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as log records of a level for each kind."""
    levels = F.create_map(*(F.lit(x) for pair in _LEVELS.items() for x in pair))
    rows = table(spark, sf_dir, "events").select("event_id", "ts", F.coalesce(F.try_element_at(levels, F.col("event_type")), F.lit("TRACE")).alias("level"))
    now = F.lit(rows.agg(F.max("ts")).first()[0]).cast("timestamp_ntz")
    line = T.log_line("ts", "level", F.concat(F.lit("event "), F.col("event_id").cast("string")))
    return rows.select("event_id", line.alias("line"), T.logged("ts", "level", now).alias("in_log"), T.logged("ts", "level", now, errors=True).alias("in_errors"))


_STRINGS = {"en": {"click": "{who} clicked", "view": "{who} looked at {what}"}, "de": {"click": "{who} hat geklickt"}}


@query(
    "translated_events",
    """select event_id, case when event_id % 3 = 0 and event_type = 'click' then user_id || ' hat geklickt' when event_id % 3 = 0 then event_type
      when event_type = 'click' then user_id || ' clicked' when event_type = 'view' then user_id || ' looked at ' || props else event_type end as said from events""",
)
def translated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third event in a language that has few texts, the others in one that isn't there."""
    language = F.when(F.col("event_id") % 3 == 0, "de").otherwise("xx")
    return table(spark, sf_dir, "events").select("event_id", T.translated(_STRINGS, language, "event_type", who="user_id", what="props").alias("said"))
