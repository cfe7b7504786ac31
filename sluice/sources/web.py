"""Addresses of images in web pages, by expressions over (page_id, url, html) and over the elements that a page is read into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.markup import elements, tagged, value, within
from sluice.functions.text import absolute_url, is_decoration, is_thumbnail_source, large_variant, video_url
from sluice.operators.acquire import per_group_limit
from sluice.operators.dedup import first_rows
from sluice.session import ship

#: Fixed values.
MEDIA_URL, LISTED_URL = r"mediaurl=([^&\"]+)", r"\[\"(https://[^\"]+)\",\d+,\d+\]"
IMAGE_MARK = "jpg|jpeg|png|webp"
MAIN_IMAGE = (("figure", "lede-image"), ("div", "main-image"), ("figure", "image"), ("div", "image-wrapper"))
PAGE_URLS = 10


def unquoted(c: Column) -> Column:
    """Percent-decoding that keeps plus signs; what can't be decoded stays."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def listed_urls(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, pos, url): addresses that a result page lists, first seen first: all mediaurl parameters, then all listed ones."""
    media = F.transform(F.regexp_extract_all(html, F.lit(MEDIA_URL), F.lit(1)), unquoted)
    plain = F.transform(
        F.regexp_extract_all(html, F.lit(LISTED_URL), F.lit(1)),
        lambda u: F.replace(F.replace(u, F.lit("\\u003d"), F.lit("=")), F.lit("\\u0026"), F.lit("&")),
    )
    good = F.concat(
        F.filter(media, lambda u: u.rlike(IMAGE_MARK) & u.startswith("http")),
        F.filter(plain, lambda u: u.rlike(IMAGE_MARK)),
    )
    return pages.select(key, F.posexplode(F.array_distinct(good)).alias("pos", "url"))


def links(pages: DataFrame, base: Column | str = "", key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, pos, url) of every href, absolute by putting the base before, first seen first."""
    found = _read(pages, key, html, ["a"], ["href"])
    hrefs = F.array_compact(F.transform("found", lambda e: value(e, "href")))
    return found.select(key, F.posexplode(F.array_distinct(hrefs)).alias("pos", "href")).select(key, "pos", absolute_url("href", base).alias("url"))


def _read(pages: DataFrame, key: str, html: str, tags: list[str], attributes: list[str]) -> DataFrame:
    """(key, found): each page's elements with some tags."""
    ship(pages.sparkSession)
    return pages.select(key, elements(html, tags, attributes).alias("found"))


def _filled(element: Column, name: str) -> Column:
    return F.nullif(value(element, name), F.lit(""))


def _source(element: Column) -> Column:
    return F.coalesce(_filled(element, "src"), _filled(element, "data-src"))


def article_links(pages: DataFrame, base: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, pos, url): links of class card-image, or else the first link in each article; empty ones go."""
    read = _read(pages, key, html, ["a", "article"], ["href"])
    anchors = read.select(key, "found", tagged(F.col("found"), "a").alias("anchors"))
    cards = tagged(F.col("anchors"), "a", "card-image")
    firsts = F.transform(tagged(F.col("found"), "article"), lambda e: F.get(within(F.col("anchors"), e), F.lit(0)))
    hrefs = F.array_compact(F.transform(F.when(F.size(cards) > 0, cards).otherwise(firsts), lambda e: _filled(e, "href")))
    return anchors.select(key, F.posexplode(hrefs).alias("pos", "href")).select(key, "pos", absolute_url("href", base).alias("url"))


def thumbnails(pages: DataFrame, base: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, pos, url): the large versions of a page's pictures."""
    read = _read(pages, key, html, ["img"], ["src", "data-src"])
    found = read.select(key, F.posexplode("found").alias("pos", "picture")).withColumn("src", _source(F.col("picture")))
    return found.where(is_thumbnail_source(F.lower("src"))).select(key, "pos", large_variant(absolute_url("src", base)).alias("url"))


def main_image(pages: DataFrame, base: str, key: str = "page_id", html: str = "html") -> DataFrame:
    """(key, url): the picture in the first of the main containers, else the first of the content that isn't decoration, else the one in the head; null without any."""
    read = _read(pages, key, html, ["figure", "div", "article", "img", "meta"], ["src", "data-src", "property", "content"])
    found, pictures = F.col("found"), F.col("pictures")
    first = lambda some: F.get(some, F.lit(0))
    main = [_source(first(within(pictures, first(tagged(found, tag, name))))) for tag, name in MAIN_IMAGE]
    content = F.coalesce(first(tagged(found, "div", "content")), first(tagged(found, "article")))
    plain = first(F.filter(F.transform(within(pictures, F.col("inner")), _source), lambda s: s.isNotNull() & ~is_decoration(s)))
    head = _filled(first(F.filter(tagged(found, "meta"), lambda e: value(e, "property") == "og:image")), "content")
    placed = read.withColumn("pictures", tagged(found, "img")).withColumn("inner", content)
    return placed.select(key, F.coalesce(large_variant(absolute_url(F.coalesce(*main, plain), base)), head).alias("url"))


def search_images(pages: DataFrame, articles: DataFrame, base: str, key: str = "page_id", html: str = "html", url: str = "url") -> DataFrame:
    """(key, pos, url) of a search page: its articles' main pictures, by an equi-join on the articles' addresses, then its own pictures."""
    linked = article_links(pages, base, key, html).withColumnRenamed("url", "at")
    main = main_image(articles.select(F.col(url).alias("at"), html), base, "at", html).where("url is not null")
    first = linked.join(main, "at").select(key, F.struct(F.lit(0).alias("part"), F.col("pos").alias("at")).alias("place"), "url")
    second = thumbnails(pages, base, key, html).select(key, F.struct(F.lit(1).alias("part"), F.col("pos").alias("at")).alias("place"), "url")
    keyed = first.unionByName(second).withColumn("_key", F.struct(key, "url"))
    return first_rows(keyed, "_key", "place").select(key, "place", "url")


def snapshot_urls(snapshots: DataFrame, most: int, key: str = "keyword", order: str = "scroll", html: str = "html") -> DataFrame:
    """(key, place, url): what the snapshots of a page that is scrolled list between them, first seen first, at most so many of each key.

    Every snapshot is the whole page as it was, so most addresses occur in all later ones.
    """
    seen = listed_urls(snapshots.withColumn("_at", F.struct(key, order)), "_at", html)
    keyed = seen.select(F.col(f"_at.{key}").alias(key), F.struct(F.col(f"_at.{order}").alias("scroll"), "pos").alias("place"), "url").withColumn("_key", F.struct(key, "url"))
    return per_group_limit(first_rows(keyed, "_key", "place").select(key, "place", "url"), key, ["place"], most)


def video_hits(entries: DataFrame, prefix: str, key: str = "keyword", order: str = "pos") -> DataFrame:
    """(key, pos, url) of the entries (key, pos, id, url) of a video search; those with neither address nor id go."""
    return entries.select(key, order, video_url("url", "id", prefix).alias("url")).where("url is not null")


def is_last_page(html: str = "html", n_urls: str = "n_urls") -> Column:
    """Whether paging ends: nothing found, no further page linked, or a short page."""
    return (F.col(n_urls) == 0) | ~F.col(html).contains("pg=") | (F.col(n_urls) < PAGE_URLS)
