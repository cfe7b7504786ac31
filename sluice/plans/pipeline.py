"""The cleaning pipeline over real files: one decode for each picture, every decision a column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import output_name
from sluice.operators import report
from sluice.operators.dedup import near_dup_greedy
from sluice.operators.quality import heuristics, large_enough, sharp
from sluice.operators.scenes import frame_names, scene_keyframes
from sluice.session import checkpointed
from sluice.sources.files import image_features, read_images
from sluice.sources.settings import Sections


@dataclass(frozen=True)
class Cleaning:
    """What the pipeline does; a threshold of None is the operator's default."""

    remove_blur: bool = True
    deduplicate: bool = True
    validate: bool = False
    sharpness: float | None = None
    hamming: int | None = None
    scene_change: float | None = None

    @classmethod
    def of(cls, settings: Sections) -> Cleaning:
        """As the settings say; what is kept is validated where they ask for it."""
        p, v = settings.processor, settings.validator
        return cls(validate=v.enabled and v.enable_heuristic, sharpness=p.blur_threshold, hamming=p.phash_threshold, scene_change=p.scene_threshold)


def clean_images(features: DataFrame, how: Cleaning = Cleaning()) -> DataFrame:
    """The features with fate and the name each kept picture gets.

    Resolution, then sharpness, then near-duplicates among what is left in order
    of path, then validation. Files stay where they are.
    """
    checked = heuristics(features)
    fate = F.when(F.col("width").isNull(), "unreadable").when(~large_enough(), "low_res")
    if how.remove_blur:
        fate = fate.when(~sharp(threshold=how.sharpness), "blur")
    marked = checkpointed(checked.withColumn("fate", fate))
    if how.deduplicate:
        near = near_dup_greedy(marked.where("fate is null"), how.hamming or 8, "path", "phash").select(F.col("id").alias("path"), F.col("fate").alias("_near"))
        marked = marked.join(near, "path", "left").withColumn("fate", F.coalesce("fate", F.nullif(F.col("_near"), F.lit("kept")))).drop("_near")
    if how.validate:
        marked = marked.withColumn("fate", F.coalesce("fate", F.when(F.col("failed_check").isNotNull(), "invalid")))
    return marked.withColumn("fate", F.coalesce("fate", F.lit("kept"))).withColumn("name", output_name("path"))


def clean_videos(frames: DataFrame, how: Cleaning = Cleaning()) -> DataFrame:
    """The keyframes (video, frame_idx, hist, lap_var) that are sharp, named by their place among all keyframes. They are neither deduplicated nor validated."""
    keys = frame_names(scene_keyframes(frames, how.scene_change).where("is_key"))
    return keys.where(sharp(threshold=how.sharpness))


def run(spark: SparkSession, folder: str, frames: DataFrame | None = None, how: Cleaning = Cleaning()) -> tuple[DataFrame, DataFrame]:
    """(images with their fates, the report in long form) of a folder of pictures and a table of frames."""
    images, counts = report.stored_with_funnel(clean_images(image_features(read_images(spark, folder)), how))
    if frames is None:
        frames = spark.createDataFrame([], "video string, frame_idx int, hist array<double>, lap_var double")
    videos = report.video_counts(frames.select("video").distinct(), clean_videos(frames, how))
    rows = report.long_form(counts, "images").unionByName(report.long_form(videos, "videos"))
    return images, rows.unionByName(report.long_form(report.combined_totals(counts, videos), "total"))
