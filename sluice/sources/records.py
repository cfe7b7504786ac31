"""Search results of image sources as one record."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import first_filled, photo_url, truncated

#: Names of licences by id.
LICENSES = {
    "0": "All Rights Reserved",
    "1": "CC BY-NC-SA 2.0",
    "2": "CC BY-NC 2.0",
    "3": "CC BY-NC-ND 2.0",
    "4": "CC BY 2.0",
    "5": "CC BY-SA 2.0",
    "6": "CC BY-ND 2.0",
    "7": "No known copyright restrictions",
    "8": "United States Government Work",
    "9": "CC0 1.0",
    "10": "Public Domain Mark",
}
#: Search parameters and read schemas of the sources.
UNSPLASH = (
    "total bigint, results array<struct<id:string,width:int,height:int,description:string,alt_description:string,"
    "user:struct<name:string>,urls:struct<regular:string,full:string,raw:string>>>"
)
PEXELS = (
    "total_results bigint, photos array<struct<id:bigint,width:int,height:int,alt:string,photographer:string,"
    "src:struct<large2x:string,large:string,original:string>>>"
)
FLICKR = (
    "stat string, message string, photos struct<pages:int,photo:array<struct<id:string,title:string,license:string,ownername:string,"
    "description:struct<_content:string>,url_k:string,url_o:string,url_l:string,server:string,secret:string>>>"
)
WIKIMEDIA = (
    "`continue` map<string,string>, query struct<pages:map<string,struct<imageinfo:array<struct<thumburl:string,url:string,width:int,"
    "height:int,extmetadata:map<string,struct<value:string>>>>>>>"
)
RECORD = ("source", "keyword", "page", "pos", "url", "id", "width", "height", "title", "description", "author", "license")


@dataclass(frozen=True)
class SourceSpec:
    """How one source's pages are read: schema, how many results there are in all, and the fields of a result."""

    name: str
    schema: str
    items: object
    fields: dict[str, object]
    total: object
    sound: object = None


def _licence():
    table = F.create_map(*(F.lit(x) for pair in LICENSES.items() for x in pair))
    return F.coalesce(F.try_element_at(table, F.col("item.license")), F.lit("Unknown"))


def _meta(key: str):
    return F.try_element_at(F.col("info.extmetadata"), F.lit(key)).getField("value")


def specs() -> dict[str, SourceSpec]:
    return {
        "unsplash": SourceSpec(
            "unsplash",
            UNSPLASH,
            lambda b: b.getField("results"),
            {
                "url": lambda: first_filled("item.urls.regular", "item.urls.full", "item.urls.raw"),
                "id": lambda: F.col("item.id"),
                "width": lambda: F.col("item.width"),
                "height": lambda: F.col("item.height"),
                "description": lambda: first_filled("item.description", "item.alt_description"),
                "author": lambda: F.col("item.user.name"),
                "license": lambda: F.lit("Unsplash License"),
            },
            lambda b: b.getField("total"),
        ),
        "pexels": SourceSpec(
            "pexels",
            PEXELS,
            lambda b: b.getField("photos"),
            {
                "url": lambda: first_filled("item.src.large2x", "item.src.large", "item.src.original"),
                "id": lambda: F.col("item.id").cast("string"),
                "width": lambda: F.col("item.width"),
                "height": lambda: F.col("item.height"),
                "description": lambda: F.col("item.alt"),
                "author": lambda: F.col("item.photographer"),
                "license": lambda: F.lit("Pexels License"),
            },
            lambda b: b.getField("total_results"),
        ),
        "flickr": SourceSpec(
            "flickr",
            FLICKR,
            lambda b: b.getField("photos").getField("photo"),
            {
                "url": lambda: F.coalesce(first_filled("item.url_k", "item.url_o", "item.url_l"), photo_url("item.server", "item.id", "item.secret")),
                "id": lambda: F.col("item.id"),
                "title": lambda: F.col("item.title"),
                "description": lambda: F.col("item.description._content"),
                "author": lambda: F.col("item.ownername"),
                "license": _licence,
            },
            lambda b: b.getField("photos").getField("pages"),
            lambda b: b.getField("stat") == "ok",
        ),
        "wikimedia": SourceSpec(
            "wikimedia",
            WIKIMEDIA,
            lambda b: F.map_entries(b.getField("query").getField("pages")),
            {
                "url": lambda: first_filled("info.thumburl", "info.url"),
                "id": lambda: F.col("item.key"),
                "width": lambda: F.col("info.width"),
                "height": lambda: F.col("info.height"),
                "description": lambda: truncated(_meta("ImageDescription"), 200),
                "author": lambda: truncated(_meta("Artist"), 100),
                "license": lambda: F.coalesce(F.nullif(_meta("LicenseShortName"), F.lit("")), F.lit("Wikimedia Commons")),
            },
            lambda b: F.when(b.getField("continue").isNotNull(), 999).otherwise(1),
        ),
    }


def parse(pages: DataFrame, source: str, body: str = "body") -> DataFrame:
    """RECORD rows of raw pages (keyword, page, body); results without an address, and bodies that aren't sound JSON, give none."""
    spec = specs()[source]
    read = pages.select("keyword", "page", F.from_json(body, spec.schema).alias("b"))
    if spec.sound is not None:
        read = read.where(spec.sound(F.col("b")))
    items = read.select("keyword", "page", F.posexplode(spec.items(F.col("b"))).alias("pos", "item"))
    if source == "wikimedia":
        items = items.withColumn("info", F.get("item.value.imageinfo", F.lit(0)))
    found = {name: make() for name, make in spec.fields.items()}
    kinds = {"width": "int", "height": "int"}
    out = [F.lit(source).alias("source"), "keyword", "page", "pos"]
    out += [found.get(n, F.lit(None)).cast(kinds.get(n, "string")).alias(n) for n in RECORD[4:]]
    return items.select(*out).where("url is not null")


def total_pages(pages: DataFrame, source: str, page_size: int, body: str = "body") -> DataFrame:
    """(keyword, pages): how many pages a source has for a keyword; 0 is unknown. Flickr and Wikimedia say so themselves."""
    spec = specs()[source]
    n = F.coalesce(spec.total(F.from_json(F.col(body), spec.schema)), F.lit(0))
    own = source in ("flickr", "wikimedia")
    return pages.groupBy("keyword").agg(F.max(n if own else F.ceil(n / page_size)).cast("long").alias("pages"))
