"""Funnels and summaries: one aggregate each, over one row per asset with its fate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sluice.session import stored

#: What can become of an asset.
FATES = ("unreadable", "low_res", "blur", "duplicate", "null_hash", "invalid", "kept")


def funnel_counters(fate: str = "fate") -> dict[str, Column]:
    """The counters of a funnel, to be aggregated or observed. Unreadable counts as low resolution, no hash as duplicate."""
    f = F.col(fate)
    return {
        "total": F.count(F.lit(1)),
        "processed": F.count_if(~f.isin("unreadable", "low_res")),
        "removed_low_res": F.count_if(f.isin("unreadable", "low_res")),
        "removed_blur": F.count_if(f == "blur"),
        "removed_duplicates": F.count_if(f.isin("duplicate", "null_hash")),
        "removed_validation": F.count_if(f == "invalid"),
        "final": F.count_if(f == "kept"),
    }


def image_funnel(assets: DataFrame, fate: str = "fate") -> DataFrame:
    """total, processed, removed_*, final in one row."""
    return assets.agg(*_named(funnel_counters(fate)))


def _named(counters: dict[str, Column]) -> list[Column]:
    return [c.alias(n) for n, c in counters.items()]


def status_counters(status: str = "status") -> dict[str, Column]:
    """The counters of progress, to be aggregated or observed."""
    s = F.col(status)
    return {
        "processed": F.count_if(s.isin("success", "failed", "skipped")),
        "success": F.count_if(s == "success"),
        "failed": F.count_if(s == "failed"),
        "skipped": F.count_if(s == "skipped"),
    }


def watched(rows: DataFrame, counters: dict[str, Column]) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """(the rows, a function that gives their counters in one row), counted while the rows are written and not by a pass of their own.

    What is watched is to be the last step before the one sink: tasks of the
    last stage count once however often they run, those of a stage before a
    shuffle may count again when an executor is lost. The function waits for the
    sink's job, and every job on the rows after the first is not counted.
    """
    seen = Observation()

    def counts() -> DataFrame:
        found = seen.get
        return rows.sparkSession.range(1).select(*(F.lit(found.get(n) or 0).cast("long").alias(n) for n in counters))

    return rows.observe(seen, *_named(counters)), counts


def stored_with_funnel(assets: DataFrame, fate: str = "fate") -> tuple[DataFrame, DataFrame]:
    """(the assets as a table in the shared folder, their funnel): one pass for both."""
    seen, counts = watched(assets, funnel_counters(fate))
    return stored(seen), counts()


def video_counts(videos: DataFrame, frames: DataFrame) -> DataFrame:
    """total_videos and total_frames_extracted; zeros where there are none."""
    return videos.agg(F.count(F.lit(1)).alias("total_videos")).crossJoin(frames.agg(F.count(F.lit(1)).alias("total_frames_extracted")))


def combined_totals(images: DataFrame, videos: DataFrame) -> DataFrame:
    """Input counts images and videos, output images and frames, and validation isn't among what is removed."""
    return images.crossJoin(videos).select(
        (F.col("total") + F.col("total_videos")).alias("total_input"),
        (F.col("final") + F.col("total_frames_extracted")).alias("total_output"),
        (F.col("removed_low_res") + F.col("removed_blur") + F.col("removed_duplicates")).alias("total_removed"),
    )


def long_form(row: DataFrame, section: str) -> DataFrame:
    """A row of counters as (section, metric, value)."""
    pairs = F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("long").alias("value")) for c in row.columns))
    return row.select(F.lit(section).alias("section"), F.inline(pairs))


def inventory(assets: DataFrame, directory: str = "directory", kind: str = "kind") -> DataFrame:
    """(directory, images, videos, label) of every directory."""
    counts = assets.groupBy(directory).agg(F.count_if(F.col(kind) == "image").alias("images"), F.count_if(F.col(kind) == "video").alias("videos"))
    return counts.withColumn("label", F.format_string("%d imgs / %d vids", "images", "videos"))


def pass_rate(assets: DataFrame, valid: str = "valid") -> DataFrame:
    """valid, invalid, total and their rate in percent, also as text with one decimal."""
    ok = F.coalesce(F.col(valid), F.lit(False))
    rate = F.when(F.count(F.lit(1)) > 0, F.count_if(ok) / F.count(F.lit(1)) * 100).otherwise(F.lit(0.0))
    return assets.agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("invalid"), F.count(F.lit(1)).alias("total"), rate.alias("rate")).withColumn(
        "shown", F.format_string("%.1f", "rate")
    )


def progress(items: DataFrame, total: int, status: str = "status", started=None, ended=None) -> DataFrame:
    """processed, success, failed, skipped, progress_pct, error_count (and elapsed seconds) of items by status."""
    return progress_of(items.agg(*_named(status_counters(status))), total, started, ended)


def progress_of(counts: DataFrame, total: int, started=None, ended=None) -> DataFrame:
    """The summary of one row of progress counters, aggregated or watched."""
    out = counts.select(
        F.lit(total).cast("long").alias("total"),
        *counts.columns,
        (F.col("processed") / F.lit(total) * 100 if total else F.lit(0.0)).alias("progress_pct"),
        F.col("failed").alias("error_count"),
    )
    if started is not None and ended is not None:
        out = out.withColumn("elapsed_seconds", (F.unix_micros(F.lit(ended)) - F.unix_micros(F.lit(started))) / 1e6)
    return out
