"""Search results, pages and pictures read by the sources' own operators, from bodies built out of the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import pixels
from sluice.functions import text as T
from sluice.operators.acquire import first_of
from sluice.operators.quality import large_enough, normalized_size
from sluice.plans.registry import query
from sluice.session import ship, table
from sluice.sources import records, web

#: Results a page.
PAGE = 10


def _bodies(spark: SparkSession, sf_dir: str, item, body) -> DataFrame:
    """(keyword, page, body): documents of a source, in order of id, as pages of JSON results."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", F.floor(F.col("doc_id") / PAGE).cast("int").alias("page"))
    items = docs.groupBy(F.col("source").alias("keyword"), "page").agg(F.array_sort(F.collect_list(F.struct("doc_id", item.alias("item")))).alias("items"))
    return items.select("keyword", "page", F.to_json(body(F.transform("items", lambda i: i["item"]))).alias("body"))


_PLACED = f"""
    placed as (select doc_id, source, lang, n_chars, doc_id // {PAGE} as page, row_number() over (partition by source, doc_id // {PAGE} order by doc_id) - 1 as pos from documents)"""
_OUT = ("keyword", "page", "pos", "url", "id", "width", "title", "description", "author", "license")


def _address(n: str) -> object:
    return F.concat(F.lit(f"http://{n}/"), F.col("doc_id").cast("string"))


@query(
    "records_unsplash",
    f"""with {_PLACED}
    select source as keyword, page::int as page, pos::int as pos, case when doc_id % 3 = 0 then 'http://full/' else 'http://regular/' end || doc_id as url, 'u' || doc_id as id,
      n_chars::int as width, null::varchar as title, case when lang = 'en' then 'alt ' || source else lang end as description, source as author, 'Unsplash License' as license
    from placed where doc_id % 7 <> 0""",
)
def records_unsplash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third result has no regular size, every seventh no address at all."""
    none = F.col("doc_id") % 7 == 0
    urls = F.struct(
        F.when(none | (F.col("doc_id") % 3 == 0), "").otherwise(_address("regular")).alias("regular"),
        F.when(~none, _address("full")).alias("full"),
        F.lit(None).cast("string").alias("raw"),
    )
    item = F.struct(
        F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("id"),
        F.col("n_chars").alias("width"),
        F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("description"),
        F.concat(F.lit("alt "), F.col("source")).alias("alt_description"),
        F.struct(F.col("source").alias("name")).alias("user"),
        urls.alias("urls"),
    )
    pages = _bodies(spark, sf_dir, item, lambda items: F.struct(F.size(items).alias("total"), items.alias("results")))
    return records.parse(pages, "unsplash").select(*_OUT)


@query(
    "records_pexels",
    f"""with {_PLACED}
    select source as keyword, page::int as page, pos::int as pos, case doc_id % 3 when 0 then 'http://large2x/' when 1 then 'http://large/' else 'http://original/' end || doc_id as url, doc_id::varchar as id,
      n_chars::int as width, null::varchar as title, lang as description, source as author, 'Pexels License' as license from placed""",
)
def records_pexels(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("doc_id") % 3
    src = F.struct(F.when(kind == 0, _address("large2x")).alias("large2x"), F.when(kind <= 1, _address("large")).alias("large"), _address("original").alias("original"))
    item = F.struct(F.col("doc_id").alias("id"), F.col("n_chars").alias("width"), F.col("lang").alias("alt"), F.col("source").alias("photographer"), src.alias("src"))
    pages = _bodies(spark, sf_dir, item, lambda items: F.struct(F.size(items).alias("total_results"), items.alias("photos")))
    return records.parse(pages, "pexels").select(*_OUT)


@query(
    "records_flickr",
    f"""with {_PLACED}
    select source as keyword, page::int as page, pos::int as pos,
      case when doc_id % 2 = 0 then 'http://o/' || doc_id else 'https://live.staticflickr.com/' || n_chars || '/' || doc_id || '_s' || '_b.jpg' end as url, doc_id::varchar as id,
      null::int as width, lang as title, 'about ' || lang as description, source as author, case doc_id % 3 when 0 then 'All Rights Reserved' when 1 then 'Public Domain Mark' else 'Unknown' end as license
    from placed where page % 4 <> 3 and (doc_id % 2 = 0 or doc_id % 5 <> 0)""",
)
def records_flickr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every fourth page says that it failed; odd results have only the parts of an address, and every fifth of them lacks one."""
    odd = F.col("doc_id") % 2 == 1
    licence = F.when(F.col("doc_id") % 3 == 0, "0").when(F.col("doc_id") % 3 == 1, "10").otherwise("42")
    item = F.struct(
        F.col("doc_id").cast("string").alias("id"),
        F.col("lang").alias("title"),
        licence.alias("license"),
        F.col("source").alias("ownername"),
        F.struct(F.concat(F.lit("about "), F.col("lang")).alias("_content")).alias("description"),
        F.when(~odd, _address("o")).alias("url_o"),
        F.col("n_chars").cast("string").alias("server"),
        F.when(F.col("doc_id") % 5 == 0, "").otherwise("s").alias("secret"),
    )
    pages = _bodies(spark, sf_dir, item, lambda items: F.struct(F.when(F.col("page") % 4 == 3, "fail").otherwise("ok").alias("stat"), F.struct(F.lit(1).alias("pages"), items.alias("photo")).alias("photos")))
    return records.parse(pages, "flickr").select(*_OUT)


@query(
    "records_wikimedia",
    """select source as keyword, (doc_id)::int as page, 0 as pos, 'http://' || case when doc_id % 2 = 0 then 'thumb/' else 'whole/' end || doc_id as url, doc_id::varchar as id, n_chars::int as width,
      null::varchar as title, left(repeat(lang || ' ', 90), 200) as description, nullif(case when lang = 'en' then '' else source end, '') as author,
      case when lang = 'fr' then 'Wikimedia Commons' else 'CC ' || lang end as license from documents where doc_id % 3 <> 0""",
)
def records_wikimedia(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page for each result, and every third without picture information."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars")
    value = lambda c: F.struct(c.alias("value"))
    meta = F.create_map(
        F.lit("ImageDescription"), value(F.repeat(F.concat("lang", F.lit(" ")), F.lit(90))),
        F.lit("Artist"), value(F.when(F.col("lang") == "en", "").otherwise(F.col("source"))),
        F.lit("LicenseShortName"), value(F.when(F.col("lang") == "fr", "").otherwise(F.concat(F.lit("CC "), F.col("lang")))),
    )
    info = F.struct(F.when(F.col("doc_id") % 2 == 0, _address("thumb")).alias("thumburl"), _address("whole").alias("url"), F.col("n_chars").alias("width"), meta.alias("extmetadata"))
    found = F.create_map(F.col("doc_id").cast("string"), F.struct(F.when(F.col("doc_id") % 3 != 0, F.array(info)).alias("imageinfo")))
    body = F.to_json(F.struct(F.struct(found.alias("pages")).alias("query")))
    return records.parse(docs.select(F.col("source").alias("keyword"), F.col("doc_id").cast("int").alias("page"), body.alias("body")), "wikimedia").select(*_OUT)


BASE = "https://b.org"
_KINDS = {
    0: '<figure class="lede-image big"><img alt="x" src="/m{}_th.png"></figure><div class="content"><img src="/no.png"></div>',
    1: '<div class="content"><img src="/icon{}.png"><img data-src="/c{}_med.jpg"></div>',
    2: '<article><p><img src="http://x/a{}.gif"></article>',
    3: '<head><meta property="og:image" content="http://og/{}"></head><div class="content"><img src="/logo.png"></div>',
    4: "<p>none</p>",
}


def _pictured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with pictures put before what they say."""
    added = None
    for k, form in _KINDS.items():
        part = F.replace(F.lit(form), F.lit("{}"), F.col("page_id").cast("string"))
        added = F.when(F.col("page_id") % 5 == k, part) if added is None else added.when(F.col("page_id") % 5 == k, part)
    return table(spark, sf_dir, "pages").select("page_id", "url", F.concat(added, F.lit("<hr>")).alias("html"))


@query(
    "main_images",
    """select page_id, case page_id % 5 when 0 then 'https://b.org/m' || page_id || '_lrg.png' when 1 then 'https://b.org/c' || page_id || '_lrg.jpg'
      when 2 then 'http://x/a' || page_id || '.gif' when 3 then 'http://og/' || page_id end as url from pages""",
)
def main_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.main_image(_pictured(spark, sf_dir), BASE)


@query(
    "thumbnail_urls",
    """select page_id, pos::int as pos, url from (
      select page_id, 0 as pos, 'https://b.org/m' || page_id || '_lrg.png' as url from pages where page_id % 5 = 0 union all
      select page_id, 1, 'https://b.org/no.png' from pages where page_id % 5 = 0 union all
      select page_id, 0, 'https://b.org/icon' || page_id || '.png' from pages where page_id % 5 = 1 union all
      select page_id, 1, 'https://b.org/c' || page_id || '_lrg.jpg' from pages where page_id % 5 = 1 union all
      select page_id, 0, 'https://b.org/logo.png' from pages where page_id % 5 = 3)""",
)
def thumbnail_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.thumbnails(_pictured(spark, sf_dir), BASE)


#: The same in markup as it is met: nested containers, other quotes and cases, attributes in any order, class names that only begin like others.
_UNTIDY = {
    0: '<DIV CLASS=\'main-image x\'><div><span>a &lt; b</span></div><IMG alt="a > b" SRC=/m{}_th.png></DIV><div class="content"><img src="/no.png"></div>',
    1: '<div class="content-wrapper"><img src="/w.png"></div><!-- <div class="content"><img src="/z.png"> --><div class=content><div><p>x</div><img src=\'/button.png\'><img data-src="/c{}_med.JPG?a=1&amp;b=2" src></div>',
    2: '<script>"<article><img src=/s.png>"</script></p><article><section><a href=/deep{}>x</a><a HREF=\'/second\'>y</a><img src=http://x/a{}.gif></section></article>',
    3: '<meta content="http://og/{}?a&amp;b" property="og:image"><div class="content"><img src="/logo.png"></div><a class="big card-image" href="/card{}">z</a><article><a href="/plain">x</a></article>',
    4: '<figure class="image"></figure><div class="image-wrapper"><img src="/f{}.png"',
}


def _untidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.create_map(*(F.lit(x) for pair in _UNTIDY.items() for x in pair))
    said = F.replace(F.try_element_at(form, (F.col("page_id") % 5).cast("int")), F.lit("{}"), F.col("page_id").cast("string"))
    return table(spark, sf_dir, "pages").select("page_id", "url", F.when(F.col("page_id") % 5 == 4, F.concat("html", said)).otherwise(F.concat(said, F.lit("<hr>"))).alias("html"))


@query(
    "untidy_main_images",
    """select page_id, case page_id % 5 when 0 then 'https://b.org/m' || page_id || '_lrg.png' when 1 then 'https://b.org/c' || page_id || '_lrg.JPG?a=1&b=2'
      when 2 then 'http://x/a' || page_id || '.gif' when 3 then 'http://og/' || page_id || '?a&b' end as url from pages""",
)
def untidy_main_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.main_image(_untidy(spark, sf_dir), BASE)


@query(
    "untidy_thumbnails",
    """select page_id, pos::int as pos, url from (
      select page_id, 0 as pos, 'https://b.org/m' || page_id || '_lrg.png' as url from pages where page_id % 5 = 0 union all
      select page_id, 1, 'https://b.org/no.png' from pages where page_id % 5 = 0 union all
      select page_id, 0, 'https://b.org/w.png' from pages where page_id % 5 = 1 union all
      select page_id, 1, 'https://b.org/button.png' from pages where page_id % 5 = 1 union all
      select page_id, 2, 'https://b.org/c' || page_id || '_lrg.JPG?a=1&b=2' from pages where page_id % 5 = 1 union all
      select page_id, 0, 'https://b.org/logo.png' from pages where page_id % 5 = 3)""",
)
def untidy_thumbnails(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.thumbnails(_untidy(spark, sf_dir).where("page_id % 5 < 4"), BASE)


@query(
    "untidy_article_links",
    """select page_id, 0::int as pos, 'https://b.org/' || case page_id % 5 when 2 then 'deep' else 'card' end || page_id as url from pages where page_id % 5 in (2, 3)""",
)
def untidy_article_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards where there are any, else the first link in each article."""
    return web.article_links(_untidy(spark, sf_dir).where("page_id % 5 < 4"), BASE)


@query(
    "search_pictures",
    """with linked as (select page_id as s, (page_id + 1) % ((select max(page_id) from pages) + 1) as t from pages),
    main as (
      select page_id, case page_id % 5 when 0 then 'https://b.org/m' || page_id || '_lrg.png' when 1 then 'https://b.org/c' || page_id || '_lrg.jpg'
        when 2 then 'http://x/a' || page_id || '.gif' when 3 then 'http://og/' || page_id end as url from pages)
    select s as page_id, 0::int as part, url from linked join main on page_id = t where url is not null
    union all select page_id, 1, 'https://b.org/own' || page_id || '_lrg.png' from pages""",
)
def search_pictures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages that link the next page's article in a card and show a picture of their own."""
    articles = _pictured(spark, sf_dir).withColumn("url", F.concat(F.lit(BASE + "/at/"), F.col("page_id").cast("string")))
    pages = table(spark, sf_dir, "pages").select("page_id")
    following = (F.col("page_id") + 1) % (F.col("most") + 1)
    form = F.concat(F.lit("<a href='/at/"), following.cast("string"), F.lit("' class='card-image'></a><article><img src=/own"), F.col("page_id").cast("string"), F.lit("_th.png></article>"))
    found = web.search_images(pages.crossJoin(pages.agg(F.max("page_id").alias("most"))).select("page_id", form.alias("html")), articles, BASE)
    return found.select("page_id", "place.part", "url")


@query(
    "listed_picture_urls",
    r"""select page_id, pos::int as pos, url from (
      select page_id, 0 as pos, url || '/a b+c.jpg' as url from pages where starts_with(url, 'http') union all
      select page_id, case when starts_with(url, 'http') then 1 else 0 end, 'https://l/' || page_id || '.png?x=1&y=2' from pages)""",
)
def listed_picture_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result pages with an encoded address twice, one that isn't a picture's, and an escaped one in a list."""
    encoded = F.replace(F.replace(F.url_encode("url"), F.lit("+"), F.lit("%20")), F.lit("%2B"), F.lit("+"))
    media = F.concat(F.lit("mediaurl="), encoded, F.lit('%2Fa%20b+c.jpg"'))
    listed = F.concat(F.lit('["https://l/'), F.col("page_id").cast("string"), F.lit('.png?x\\u003d1\\u0026y\\u003d2",600,800]["https://l/no",1,2]'))
    pages = table(spark, sf_dir, "pages").select("page_id", F.concat(media, F.lit(" "), media, F.lit(' mediaurl=ftp%3A%2F%2Fx.jpg" '), listed).alias("html"))
    return web.listed_urls(pages)


@query(
    "search_addresses",
    """select page_id, case when page_id % 2 = 0 then 'https://www.bing.com/images/search?q=' || replace(lang, ' ', '%20') || '%20flood' || '&count=150'
      else 'https://www.google.com/search?q=' || lang || ' flood' || '&tbm=isch&ijn=0' end as url
    from (select doc_id as page_id, lang from documents)""",
)
def search_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), F.concat("lang", F.lit(" flood")).alias("k"))
    return words.select("page_id", F.when(F.col("page_id") % 2 == 0, T.search_url("bing", "k")).otherwise(T.search_url("google", "k")).alias("url"))


@query(
    "path_predicates",
    """with p as (select page_id, case page_id % 5 when 0 then '/a/B.JPG' when 1 then '/a/.png' when 2 then '/a.b/c' when 3 then '/v.MKV' else '/icon.jpeg' end as path,
        case page_id % 3 when 0 then 'Sign in to confirm you are not a bot' when 1 then 'timeout' end as message from pages)
    select page_id, path in ('/a/B.JPG', '/icon.jpeg') as image, path = '/v.MKV' as video, path in ('/a/.png', '/icon.jpeg') as thumbnail, path = '/icon.jpeg' as decoration,
      contains(message, 'bot') as blocked from p""",
)
def path_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    k = F.col("page_id") % 5
    path = F.when(k == 0, "/a/B.JPG").when(k == 1, "/a/.png").when(k == 2, "/a.b/c").when(k == 3, "/v.MKV").otherwise("/icon.jpeg")
    message = F.when(F.col("page_id") % 3 == 0, "Sign in to confirm you are not a bot").when(F.col("page_id") % 3 == 1, "timeout")
    rows = pages.select("page_id", path.alias("path"), message.alias("message"))
    return rows.select(
        "page_id",
        T.is_image("path").alias("image"),
        T.is_video("path").alias("video"),
        T.is_thumbnail_source("path").alias("thumbnail"),
        T.is_decoration("path").alias("decoration"),
        T.blocked_as_bot("message").alias("blocked"),
    )


@query(
    "size_rules",
    """with s as (select l_orderkey, l_linenumber, (l_partkey % 2500)::int as w, (l_suppkey * 37 % 1500)::int as h from lineitem)
    select l_orderkey, l_linenumber, w >= 480 and h >= 360 as large, case when w > 1920 or h > 1080 then 1920 else w end as width, case when w > 1920 or h > 1080 then 1080 else h end as height from s""",
)
def size_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_partkey") % 2500).cast("int").alias("w"), (F.col("l_suppkey") * 37 % 1500).cast("int").alias("h"))
    return rows.select("l_orderkey", "l_linenumber", large_enough("w", "h").alias("large"), normalized_size("w", "h").alias("n")).select("l_orderkey", "l_linenumber", "large", "n.width", "n.height")


@query("first_results", "select doc_id, source from documents order by n_chars desc, doc_id limit 25")
def first_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", (-F.col("n_chars")).alias("pos"))
    return first_of(docs, ["pos", "doc_id"], 25).select("doc_id", "source")


@query(
    "pixel_measures",
    """with p as (select vec_id, unnest(range(21)) as i, embedding as e from embeddings),
    c as (select vec_id, floor(abs(e[3 * i + 1]::double) * 1000)::bigint % 256 as b, floor(abs(e[3 * i + 2]::double) * 1000)::bigint % 256 as g, floor(abs(e[3 * i + 3]::double) * 1000)::bigint % 256 as r from p),
    m as (select *, greatest(b, g, r) as top, greatest(b, g, r) - least(b, g, r) as spread from c),
    h as (select *, case when spread = 0 then 0 when top = r then 60.0::double * (g - b) / spread when top = g then 120 + 60.0::double * (b - r) / spread else 240 + 60.0::double * (r - g) / spread end as hue,
      case when top > 0 then spread / top::double * 255 else 0 end as sat from m),
    t as (select *, round_even(case when hue < 0 then hue + 360 else hue end / 2, 0) as half from h)
    select vec_id, sum((114 * b + 587 * g + 299 * r + 500) // 1000)::bigint as gray, round(avg((half between 100 and 130 and round_even(sat, 0) >= 50 and top >= 50)::int), 6) as blue,
      count(distinct b)::bigint as blues from t group by vec_id""",
)
def pixel_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as pictures of three by seven pixels: grey, blue share, and the bins that the histogram fills."""
    import numpy as np
    import pandas as pd

    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    ship(spark)

    def run(parts):
        for part in parts:
            rows = []
            for e in part["embedding"]:
                p = (np.floor(np.abs(np.asarray(e, float)[:63]) * 1000).astype(np.int64) % 256).astype(np.uint8).reshape(3, 7, 3)
                rows.append((int(pixels.gray(p).sum()), round(pixels.blue_share(p), 6), int((pixels.histogram(p)[:256] > 0).sum())))
            yield pd.DataFrame({"vec_id": part["vec_id"]} | dict(zip(("gray", "blue", "blues"), zip(*rows))))

    return vectors.mapInPandas(run, "vec_id bigint, gray bigint, blue double, blues bigint")
