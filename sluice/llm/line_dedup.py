"""Line dedup by site-relative frequency.

A line's frequency on a site is the share of the site's pages that contain it;
lines above a boilerplate ratio are dropped from the site's pages. Counting is
one aggregate over (site, hash of the line), combined before the shuffle, so a
site with a third of all pages costs each task a row per distinct line of its
own. What is counted are 64-bit hashes of trimmed lines: two different lines of
one site that share a hash, of which there are next to none, count together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.session import checkpointed

#: Lines on more than this share of a site's pages are boilerplate, on sites of MIN_PAGES pages or more, from MIN_COUNT pages on.
RATIO, MIN_PAGES, MIN_COUNT = 0.1, 5, 3
#: So many boilerplate lines are sent to every task; more are joined by their page.
BROADCAST_LINES = 200_000
#: Hashes that a line is compared with, on average.
BUCKET = 8


def _hash(line):
    return F.xxhash64(F.trim(line))


def boilerplate(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, min_count: int = MIN_COUNT, site: str = "source", text_column: str = "text") -> DataFrame:
    """(site, line_hash) of the lines to drop. Blank lines are never among them; pages with a null site form one site."""
    pages = docs.groupBy(F.col(site).alias("site")).agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    lines = docs.select(
        F.col(site).alias("site"),
        F.explode(
            F.array_distinct(F.transform(F.filter(F.split(F.col(text_column), "\n", -1), lambda x: F.trim(x) != ""), _hash))
        ).alias("line_hash"),
    )
    counts = lines.groupBy("site", "line_hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count).withColumnRenamed("site", "s")
    return (
        counts.join(pages, F.col("s").eqNullSafe(F.col("site")))
        .where(F.col("n") > F.col("pages") * F.lit(float(ratio)))
        .select("site", "line_hash")
    )


def bucketed(lines: DataFrame) -> DataFrame:
    """(_site, _hashes): the hashes of each site in as many buckets as let one hold BUCKET of them, so that looking a line up takes the same time on every site."""
    sized = lines.withColumn("buckets", F.ceil(F.count(F.lit(1)).over(Window.partitionBy("site")) / BUCKET))
    own = sized.select("site", F.pmod("line_hash", F.col("buckets")).alias("bucket"), "line_hash")
    every = sized.select("site", "buckets").distinct().select("site", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias("bucket"), F.lit(None).cast("long").alias("line_hash"))
    filled = own.union(every).groupBy("site", "bucket").agg(F.collect_list("line_hash").alias("hashes"))
    return filled.groupBy(F.col("site").alias("_site")).agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "hashes"))), lambda b: b["hashes"]).alias("_hashes"))


def dedup_lines(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, min_count: int = MIN_COUNT, site: str = "source", text_column: str = "text", id_column: str = "doc_id", dropped: str | None = "n_dropped", length_column: str | None = "n_chars", spare_copies: bool = False) -> DataFrame:
    """The documents with boilerplate lines taken out of their texts; all rows and columns stay.

    ``dropped`` names a column with the number of lines taken out, None adds
    none; a length column, if there is one, counts the code points left where a
    line was taken out. With ``spare_copies`` a page that would lose all it says
    stays as it is: it is a copy of a page, and which of those stay is for a
    near-duplicate stage to say. Null texts stay null and empty ones empty; repeated rows
    stay and count as pages; an empty table stays empty.
    """
    # whatever the columns are called, within they go by number
    names, kinds = docs.columns, [kind for _, kind in docs.dtypes]
    places = {n: f"c{names.index(n)}" for n in (site, text_column)}
    docs = docs.toDF(*(f"c{k}" for k in range(len(names))))
    site, text = places[site], places[text_column]
    lines = checkpointed(boilerplate(docs, ratio, min_pages, min_count, site, text))
    several = lines.limit(BROADCAST_LINES + 1).count()
    split = F.split(F.col(text), "\n", -1)
    # a site's hashes in buckets of a few: small enough to be everywhere, or else joined by site and hash and gathered by page
    if several <= BROADCAST_LINES:
        found = docs.join(F.broadcast(bucketed(lines)), F.col(site).eqNullSafe(F.col("_site")), "left")
    else:
        rows = checkpointed(docs.withColumn("_row", F.monotonically_increasing_id()))
        mine = rows.select("_row", F.col(site).alias("_site"), F.explode(F.array_distinct(F.transform(split, _hash))).alias("_hash"))
        hits = (
            mine.join(lines, F.col("_site").eqNullSafe(F.col("site")) & (F.col("_hash") == F.col("line_hash")))
            .groupBy("_row")
            .agg(F.array(F.collect_set("_hash")).alias("_hashes"))
        )
        found = rows.join(hits, "_row", "left")
    bucket = lambda h: F.get("_hashes", F.pmod(h, F.size("_hashes")).cast("int"))
    kept = F.filter(split, lambda x: ~F.array_contains(bucket(_hash(x)), _hash(x)))
    hit = F.col("_hashes").isNotNull() & (F.size(kept) < F.size(split))
    if spare_copies:
        hit &= F.exists(kept, lambda x: F.trim(x) != "")
    hit = F.coalesce(hit, F.lit(False))
    cleaned = F.when(hit, F.array_join(kept, "\n")).otherwise(F.col(text))
    out = []
    for k, (name, kind) in enumerate(zip(names, kinds)):
        value = F.col(f"c{k}")
        if name == text_column:
            value = cleaned
        elif name == length_column:
            value = F.when(hit, F.char_length(cleaned).cast(kind)).otherwise(value)
        out.append(value.alias(name))
    if dropped:
        out.append(F.when(hit, F.size(split) - F.size(kept)).otherwise(0).cast("long").alias(dropped))
    return found.select(*out)


def oracle(ratio: float = RATIO, min_pages: int = MIN_PAGES, min_count: int = MIN_COUNT) -> str:
    """DuckDB's twin of the query over documents."""
    return f"""
    with pages as (select source, count(*) as pages from documents group by source having count(*) >= {min_pages}),
    lines as (
      select distinct doc_id, source, trim(line, ' ') as line
      from (select doc_id, source, unnest(string_split(text, chr(10))) as line from documents) where trim(line, ' ') <> ''),
    bad as (
      select l.source, line from lines l join pages p on l.source is not distinct from p.source
      group by l.source, line, pages having count(*) >= {min_count} and count(*) > pages * {float(ratio)}),
    pieces as (
      select doc_id, source, i, string_split(text, chr(10))[i] as line
      from (select doc_id, source, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i from documents)),
    marked as (
      select p.doc_id, p.i, p.line, b.line is not null as gone
      from pieces p left join bad b on p.source is not distinct from b.source and trim(p.line, ' ') = b.line),
    joined as (
      select doc_id, coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '') as text, count(*) filter (where gone) as n_dropped
      from marked group by doc_id)
    select d.doc_id, case when d.text is null then null else j.text end as text, coalesce(n_dropped, 0)::bigint as n_dropped
    from documents d left join joined j using (doc_id)"""
