from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from sluice.operators import report
from sluice.session import free
from sluice.sources.lists import Checkpoint

FATES = ["kept", "blur", "low_res", "unreadable", "duplicate", "null_hash", "invalid", "kept", None]


def fates(spark, n=900):
    names = F.array(*(F.lit(f) for f in FATES))
    return spark.range(n).select("id", F.element_at(names, (F.col("id") % len(FATES) + 1).cast("int")).alias("fate"))


def test_a_watched_table_is_counted_while_it_is_written(spark):
    reads = spark.sparkContext.accumulator(0)

    def read(parts):
        for part in parts:
            reads.add(len(part))
            yield part

    assets = fates(spark).mapInPandas(read, "id long, fate string")
    table, counts = report.stored_with_funnel(assets)
    found = counts.first()
    assert reads.value == 900
    assert found == report.image_funnel(fates(spark)).first() and table.count() == 900
    free(table)


def test_watching_an_empty_table_counts_nothing(spark):
    for empty in (fates(spark).where("id < 0"), spark.createDataFrame([], "fate string")):
        table, counts = report.stored_with_funnel(empty)
        assert set(counts.first().asDict().values()) == {0} and table.count() == 0


def test_progress_of_watched_items_is_that_of_aggregated_ones(spark):
    items = spark.range(40).select(F.element_at(F.array(*map(F.lit, ["success", "failed", "skipped", "waiting"])), (F.col("id") % 4 + 1).cast("int")).alias("status"))
    seen, counts = report.watched(items, report.status_counters())
    seen.write.format("noop").mode("overwrite").save()
    assert report.progress_of(counts(), 40).first() == report.progress(items, 40).first()
    assert report.progress(items, 40).first()["progress_pct"] == 75.0


def test_many_appends_leave_few_files(spark, tmp_path):
    path = str(tmp_path / "done")
    done = Checkpoint(spark, path, most_batches=4)
    for k in range(30):
        done.add("a b/c*[1]", spark.range(k * 10, k * 10 + 20).selectExpr("concat('i', id) as item_id"))
        assert len(done.batches("a b/c*[1]")) <= 2 * 5
    done.add("other", spark.createDataFrame([("i1",), (None,)], "item_id string"))
    found = done.load("a b/c*[1]")
    assert found.count() == found.select("item_id").distinct().count() == 310
    assert [r["item_id"] for r in done.load("other").collect()] == ["i1"] and done.load().count() == 311
    done.clear("a b/c*[1]")
    assert done.load().count() == 1
    done.clear()
    assert done.load().count() == 0
    with pytest.raises(ValueError):
        done.add("", spark.range(1).selectExpr("id as item_id"))


def test_two_writers_of_the_same_items_leave_each_once(spark, tmp_path):
    path = str(tmp_path / "done")
    writers = [Checkpoint(spark, path, most_batches=1000) for _ in range(2)]
    with ThreadPoolExecutor(2) as pool:
        for _ in pool.map(lambda w: [w.add("t", spark.range(50).selectExpr("id as item_id")) for _ in range(3)], writers):
            pass
    done = Checkpoint(spark, path, most_batches=1)
    assert done.load("t").count() == 50
    done.compact("t")
    assert done.load("t").count() == 50 and len(done.batches("t")) <= 2


def test_a_merge_that_dies_before_it_deletes_loses_and_doubles_nothing(spark, tmp_path):
    path = str(tmp_path / "done")
    done = Checkpoint(spark, path, most_batches=1000)
    for k in range(4):
        done.add("t", spark.range(k * 5, k * 5 + 5).selectExpr("id as item_id"))
    before = done.load("t").collect()
    done.most_batches, done._delete = 1, lambda path: None
    done.compact("t")
    assert sorted(done.load("t").collect()) == sorted(before) and len(before) == 20
