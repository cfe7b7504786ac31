"""The operators that keep up with growing inputs."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sluice.operators.rate import WINDOW_SECONDS
from sluice.session import ship
from sluice.sources.lists import Checkpoint

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_TIMED = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def growing_folder(spark: SparkSession, folder: str, schema: str, kind: str = "parquet", most_files: int = 1000) -> DataFrame:
    """New files of a folder as a stream."""
    return spark.readStream.format(kind).schema(schema).option("maxFilesPerTrigger", most_files).load(folder)


def first_seen(stream: DataFrame, key: list[str], ts: str = "ts", within: str = "1 hour") -> DataFrame:
    """The first row of each key, by arrival; a key is forgotten once the watermark has passed it."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, within).dropDuplicatesWithinWatermark(key)


def window_counts(stream: DataFrame, key: str, ts: str = "ts", window: str = "1 hour", slide: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """(key, start, end, n): events in sliding windows, final once the watermark has passed their end."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    counts = timed.groupBy(F.window(ts, window, slide), key).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(key, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "n")


def funnel(stream: DataFrame, fate: str = "fate") -> DataFrame:
    """(fate, n) so far, for output mode complete or update."""
    return stream.groupBy(fate).agg(F.count(F.lit(1)).alias("n"))


class Admissions(StatefulProcessor):
    """Of a key: the events that wait for the watermark, and when the last ones were admitted."""

    def __init__(self, limit: int, window: int, names: list[str], event_type: str):
        self.limit, self.window, self.names, self.event_type = limit, window, names, event_type

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"us bigint, event {self.event_type}")
        self.recent = handle.getListState("recent", "us bigint")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = [pair for part in rows for pair in zip(part["arrival_us"].tolist(), part["arrival_event"].tolist())]
        yield from self._released(key, new, timerValues)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        yield from self._released(key, [], timerValues)

    def _released(self, key: Any, new: list[tuple[int, Any]], timers: Any) -> Iterator[pd.DataFrame]:
        """What the watermark has passed is admitted in order of time; a timer is set for the first of the others."""
        seen = timers.getCurrentWatermarkInMs() * 1000
        ordered = sorted([*self.waiting.get(), *new])
        ready = [pair for pair in ordered if pair[0] <= seen]
        later = ordered[len(ready) :]
        if later:
            self.waiting.put(later)
            self.handle.registerTimer(-(-later[0][0] // 1000))
        else:
            self.waiting.clear()
        if not ready:
            return
        recent = deque((us for (us,) in self.recent.get()), maxlen=self.limit)
        admitted = []
        for us, _ in ready:
            admitted.append(max(us, recent[0] + self.window) if len(recent) == self.limit else us)
            recent.append(admitted[-1])
        if recent[-1] + self.window > seen:
            self.recent.put([(us,) for us in recent])
        else:  # nothing that still comes has to wait for these
            self.recent.clear()
        arrived = [us for us, _ in ready]
        columns = [[key[0]] * len(ready), [event for _, event in ready], arrived, admitted, [a - us for a, us in zip(admitted, arrived)]]
        yield pd.DataFrame(dict(zip(self.names, columns)))


def admissions(stream: DataFrame, limit: int, key: str = "source", ts: str = "ts", event: str = "event_id", seconds: int = WINDOW_SECONDS, late: str = "10 minutes") -> DataFrame:
    """(key, event, arrived_us, admitted_us, waited_us): what ``rate.admissions`` says, as soon as the watermark has passed an event.

    Events may come in any order within ``late``; those that come later still,
    or have no time, take no part. Keys hold the events that wait and ``limit``
    admissions, in the stream's checkpoint, so a stream that is started again
    goes on where it was. A key is one task, and its events of one trigger and
    of ``late`` are sorted there: bound them by the trigger. A limit of 0 admits
    all at once. Timers need the RocksDB state store, which the session is set
    to. Output mode append.
    """
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).where(F.col(ts).isNotNull())
    us = F.unix_micros(F.col(ts))
    names = [key, event, "arrived_us", "admitted_us", "waited_us"]
    if limit == 0:
        return timed.select(key, event, us.alias("arrived_us"), us.alias("admitted_us"), F.lit(0).cast("long").alias("waited_us"))
    stream.sparkSession.conf.set(_PROVIDER, _TIMED)
    ship(stream.sparkSession)
    types = {f.name: f.dataType.simpleString() for f in timed.schema.fields}
    rows = timed.withWatermark(ts, late).select(F.col(key), F.col(ts), us.alias("arrival_us"), F.col(event).alias("arrival_event"))
    schema = f"`{key}` {types[key]}, `{event}` {types[event]}, arrived_us bigint, admitted_us bigint, waited_us bigint"
    return rows.groupBy(key).transformWithStateInPandas(Admissions(limit, seconds * 1_000_000, names, types[event]), schema, "Append", "EventTime")


def worked_off(stream: DataFrame, done: Checkpoint, task: str, work: Callable[[DataFrame], DataFrame], item: str = "item_id"):
    """A stream writer that gives ``work`` the items of each batch that aren't done, once each, and marks those that it returns.

    ``work`` does what it does as it runs, or as its result is read, and returns
    the items that succeeded; the others come again when they are sent again. An
    item may be worked on twice if the process dies before it is marked. Items
    without an id are left out. Set the checkpoint and trigger, then start it.
    """

    def batch(rows: DataFrame, _: int) -> None:
        known = done.load(task).select(F.col("item_id").alias(item))
        asked = rows.where(F.col(item).isNotNull()).withColumn(item, F.col(item).cast("string")).dropDuplicates([item])
        done.add(task, work(asked.join(known, item, "left_anti")), item)

    return stream.writeStream.foreachBatch(batch)
