"""Rate windows: counting, remaining requests, and admission."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.order import ranked, running_max

WINDOW_SECONDS = 3600


def window_counts(events: DataFrame, key: str = "source", ts: str = "ts", seconds: int = WINDOW_SECONDS) -> DataFrame:
    """Events with ``in_window``: the events of their key less than so many seconds old, themselves included.

    The frame is half-open: an event just that old is out. Rows at one time see
    each other, and so do those without a time. Events are dealt by key and
    stretch of time, each also as the past of the next stretch, so no task gets
    all of a key.
    """
    since = F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts).cast("timestamp_ntz"))
    own = F.floor(since / seconds)
    dealt = events.withColumn("_own", own).withColumn("_in", F.explode(F.when(own.isNull(), F.array(F.lit(None).cast("long"))).otherwise(F.array(own, own + 1))))
    frame = f"count(*) over (partition by {key}, _in order by {ts} range between interval '{seconds - 1}.999999' second preceding and current row)"
    counted = dealt.withColumn("in_window", F.expr(frame))
    return counted.where(F.col("_own").eqNullSafe(F.col("_in"))).drop("_own", "_in")


def remaining(events: DataFrame, limits: DataFrame, now, key: str = "source", ts: str = "ts", seconds: int = WINDOW_SECONDS) -> DataFrame:
    """(key, remaining): what is left of each limit at a time; a limit of 0 means unlimited, null."""
    age = F.lit(now).cast("timestamp_ntz") - F.col(ts).cast("timestamp_ntz")
    used = events.where((age < F.expr(f"interval '{seconds}' second")) & (age >= F.expr("interval '0' second"))).groupBy(key).agg(F.count(F.lit(1)).alias("used"))
    left = F.greatest(F.lit(0), F.col("limit") - F.coalesce("used", F.lit(0)))
    return limits.join(used, key, "left").select(key, F.when(F.col("limit") > 0, left).cast("long").alias("remaining"))


def oldest_in_window(events: DataFrame, now, key: str = "source", ts: str = "ts", seconds: int = WINDOW_SECONDS) -> DataFrame:
    age = F.lit(now).cast("timestamp_ntz") - F.col(ts).cast("timestamp_ntz")
    return events.where(age < F.expr(f"interval '{seconds}' second")).groupBy(key).agg(F.min(ts).alias("oldest"))


def admissions(events: DataFrame, limit: int, key: str = "source", ts: str = "ts", event: str = "event_id", seconds: int = WINDOW_SECONDS) -> DataFrame:
    """(key, event, ts, admitted_us, waited_us): when each event may go if at most ``limit`` go in any window.

    admitted_n = max(arrival_n, admitted_{n-limit} + window). So the arrivals of
    a key are ``limit`` chains of every limit-th one, and in a chain what is
    admitted k-th, less k windows, is the running maximum of what arrived, less
    as many windows each: a rank and a running maximum, both cut into parts, so
    a key of any length spans many tasks. A limit of 0 admits all at once.
    """
    base = events.where(F.col(ts).isNotNull()).select(F.col(key), F.col(event), F.unix_micros(F.col(ts).cast("timestamp")).alias("us"))
    if limit == 0:
        return base.select(key, event, F.col("us").alias("arrived_us"), F.col("us").alias("admitted_us"), F.lit(0).cast("long").alias("waited_us"))
    window, rows = seconds * 1_000_000, base.count()
    placed = ranked(base, [key], ["us", event], "_n", rows).withColumn("_chain", F.col("_n") % limit).withColumn("_k", F.floor(F.col("_n") / limit))
    early = placed.withColumn("_early", F.col("us") - F.col("_k") * window)
    admitted = running_max(early, [key, "_chain"], "_k", "_early", "_most", rows).withColumn("admitted_us", F.col("_most") + F.col("_k") * window)
    return admitted.select(key, event, F.col("us").alias("arrived_us"), "admitted_us", (F.col("admitted_us") - F.col("us")).alias("waited_us"))
