import datetime as dt
import random

from pyspark.sql import functions as F

from sluice.operators import rate
from sluice.sources.lists import Checkpoint
from sluice.streaming import live

SCHEMA = "source string, ts timestamp, event_id long"
START = dt.datetime(2024, 1, 1, tzinfo=dt.UTC)


def some_events(n=120):
    rnd = random.Random(5)
    at = START
    for k in range(n):
        at += dt.timedelta(seconds=rnd.choice([0, 1, 5, 5, 40, 300]), microseconds=rnd.randrange(3))
        yield ("hot" if k % 3 else f"s{k % 2}", at, k)


def pump(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_admissions_of_a_stream_are_those_of_the_table_across_a_restart(spark, tmp_path):
    events = list(some_events())
    mixed = [sorted(events[k : k + 20], key=lambda e: e[2] * 7 % 20) for k in range(0, 120, 20)]  # out of order within a file
    folder, out, kept = (str(tmp_path / n) for n in ("in", "out", "kept"))

    def run():
        stream = live.growing_folder(spark, folder, SCHEMA, most_files=1)
        made = live.admissions(stream, 4, seconds=60, late="30 minutes")
        query = made.writeStream.format("parquet").option("checkpointLocation", kept).option("path", out).outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination(120)

    for part in mixed[:3]:
        pump(spark, folder, part)
    run()
    early = spark.read.parquet(out).count()
    for part in mixed[3:]:
        pump(spark, folder, part)
    end = events[-1][1] + dt.timedelta(hours=9)
    pump(spark, folder, [("other", end, 1000), ("hot", None, 1001)])  # the watermark passes all before
    run()
    found = sorted(tuple(r) for r in spark.read.parquet(out).where("event_id < 1000").collect())
    wanted = rate.admissions(spark.createDataFrame(events, SCHEMA), 4, seconds=60).select("source", "event_id", "arrived_us", "admitted_us", "waited_us")
    assert found == sorted(tuple(r) for r in wanted.collect()) and len(found) == 120
    assert early < 120 and any(w for *_, w in found)


def test_without_a_limit_all_are_admitted_as_they_come(spark, tmp_path):
    pump(spark, str(tmp_path / "in"), [("a", START, 1), ("a", START, 2), ("a", None, 3)])
    stream = live.growing_folder(spark, str(tmp_path / "in"), SCHEMA)
    query = live.admissions(stream, 0).writeStream.format("memory").queryName("free").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert sorted((r["event_id"], r["waited_us"]) for r in spark.sql("select * from free").collect()) == [(1, 0), (2, 0)]


def test_items_of_a_stream_are_worked_off_once_and_failed_ones_come_again(spark, tmp_path):
    folder, done, asked = str(tmp_path / "in"), Checkpoint(spark, str(tmp_path / "done")), []

    def work(items):
        asked.extend(r["item_id"] for r in items.orderBy("item_id").collect())
        return items.where(F.col("item_id") != "bad" if asked.count("bad") < 2 else F.lit(True))

    def run(*items):
        spark.createDataFrame([(i,) for i in items], "item_id string").coalesce(1).write.mode("append").parquet(folder)
        stream = live.growing_folder(spark, folder, "item_id string", most_files=1)
        query = live.worked_off(stream, done, "t", work).option("checkpointLocation", str(tmp_path / "kept")).trigger(availableNow=True).start()
        query.awaitTermination(60)

    run("a", "bad", "a", None)
    run("a", "b", "bad")
    run("b", "bad")
    assert asked == ["a", "bad", "b", "bad"] and {r["item_id"] for r in done.load("t").collect()} == {"a", "b", "bad"}
