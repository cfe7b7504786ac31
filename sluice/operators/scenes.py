"""Change points in ordered sequences of frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.functions.arrays import correlation
from sluice.operators import order as order_by
from sluice.session import checkpointed

SCENE_CHANGE = 30.0


def scene_keyframes(frames: DataFrame, threshold: float | None = None, key: list[str] | None = None, order: str = "frame_idx", histogram: str = "hist", rows: int | None = None) -> DataFrame:
    """The frames with diff and is_key, and keyframes with their ordinal from 0.

    diff is (1 - correlation with the frame before) * 100, between 0 and 200; a
    frame is a keyframe if it is the first or differs by more than the
    threshold; 0 and None mean the default. Frames are dealt by ranges of
    (key, order), so a long video spans as many tasks as it needs: the last
    frame of each part goes on to the next one, and a part's ordinals follow the
    keyframes counted before it. A table for one task takes one sort.
    """
    key = key or ["video"]
    rows = frames.count() if rows is None else rows
    parts = -(-rows // order_by.RANKED_ROWS)
    own = [*key, "_part"]
    dealt = frames.withColumn("_part", F.lit(0))
    if parts > 1:
        dealt = checkpointed(frames.repartitionByRange(parts, *key, order).withColumn("_part", F.spark_partition_id()))
    sequence = Window.partitionBy(*own).orderBy(order)
    before = F.lag(histogram).over(sequence)
    if parts > 1:
        ends = dealt.groupBy(*own).agg(F.max_by(histogram, order).alias("_end"))
        carried = ends.select(*own, F.lag("_end").over(Window.partitionBy(*key).orderBy("_part")).alias("_carried"))
        dealt = _joined(dealt, carried, own)
        before = F.when(F.row_number().over(sequence) == 1, F.col("_carried")).otherwise(before)
    diff = (1 - correlation(histogram, F.col("_before"))) * 100
    marked = (
        dealt.withColumn("_before", before)
        .withColumn("diff", F.when(F.col("_before").isNotNull(), diff))
        .withColumn("is_key", F.col("diff").isNull() | (F.col("diff") > (threshold or SCENE_CHANGE)))
    )
    ordinal = F.count_if("is_key").over(sequence.rowsBetween(Window.unboundedPreceding, 0)) - 1
    if parts > 1:
        counts = marked.groupBy(*own).agg(F.count_if("is_key").alias("_keys"))
        upto = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        marked = _joined(marked, counts.select(*own, F.coalesce(F.sum("_keys").over(upto), F.lit(0)).alias("_earlier")), own)
        ordinal = ordinal + F.col("_earlier")
    return marked.withColumn("ordinal", F.when(F.col("is_key"), ordinal)).select(*frames.columns, "diff", "is_key", "ordinal")


def _joined(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """An inner join on columns that may be null; the right side is a row for each key and part."""
    renamed = right.select(*(F.col(c).alias(f"_of_{c}") if c in on else F.col(c) for c in right.columns))
    same = F.lit(True)
    for c in on:
        same &= F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    return left.join(renamed, same).drop(*(f"_of_{c}" for c in on))


def frame_names(keyframes: DataFrame, stem: str = "video", ordinal: str = "ordinal") -> DataFrame:
    """Names by ordinal among all keyframes, those that a later filter rejects included."""
    return keyframes.withColumn("name", F.format_string("%s_frame_%05d.jpg", F.col(stem), F.col(ordinal)))
