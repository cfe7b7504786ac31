"""Files as tables: listings, decoded images, features, frames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import pixels
from sluice.functions.text import is_image, is_video
from sluice.session import ship


def scan_images(spark: SparkSession, folder: str, content: bool = False, recursive: bool = True) -> DataFrame:
    """path, modificationTime, length (and content) of image files, whatever the case of their suffix. Listings read no bytes."""
    return _scan(spark, folder, content, recursive).where(is_image("path"))


def scan_videos(spark: SparkSession, folder: str, content: bool = False, recursive: bool = True) -> DataFrame:
    return _scan(spark, folder, content, recursive).where(is_video("path"))


def _scan(spark: SparkSession, folder: str, content: bool, recursive: bool) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return files if content else files.drop("content")


def read_images(spark: SparkSession, folder: str, drop_invalid: bool = False) -> DataFrame:
    """path, width, height, channels, data (rows of blue, green, red); sizes are null where a file can't be decoded."""
    images = spark.read.format("image").option("recursiveFileLookup", "true").option("dropInvalid", drop_invalid).load(folder)
    sound = F.col("image.height") > 0
    return images.select(
        F.col("image.origin").alias("path"),
        F.when(sound, F.col("image.width")).alias("width"),
        F.when(sound, F.col("image.height")).alias("height"),
        F.when(sound, F.col("image.nChannels")).alias("channels"),
        F.when(sound, F.col("image.data")).alias("data"),
    )


def picture(data: bytes, width: int, height: int, channels: int) -> np.ndarray:
    found = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return found[..., :3] if channels >= 3 else np.repeat(found[..., :1], 3, axis=2)


def image_features(images: DataFrame, max_width: int = 1920, max_height: int = 1080) -> DataFrame:
    """path, width, height, lap_var, phash, blue, edges: one pass over each picture's pixels.

    Pictures larger than the largest size are measured as resized to just that.
    Undecoded rows have null features. Batches are small because pictures are
    large; set spark.sql.execution.arrow.maxRecordsPerBatch accordingly.
    """
    ship(images.sparkSession)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for path, w, h, c, data in zip(part["path"], part["width"], part["height"], part["channels"], part["data"]):
                if data is None:
                    rows.append((path, None, None, None, None, None, None))
                    continue
                p = picture(data, int(w), int(h), int(c))
                if w > max_width or h > max_height:
                    p = pixels.resized_picture(p, max_height, max_width)
                g = pixels.gray(p)
                rows.append((path, int(w), int(h), pixels.laplacian_variance(g), pixels.perceptual_hash(p), pixels.blue_share(p), pixels.edge_share(g)))
            out = pd.DataFrame(rows, columns=["path", "width", "height", "lap_var", "phash", "blue", "edges"], dtype=object)
            yield out

    ddl = "path string, width int, height int, lap_var double, phash bigint, blue double, edges double"
    return images.select("path", "width", "height", "channels", "data").mapInPandas(run, ddl)


def frame_features(frames: DataFrame) -> DataFrame:
    """video, frame_idx, hist, lap_var of decoded frames (video, frame_idx, width, height, channels, data)."""
    ship(frames.sparkSession)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = [picture(d, int(w), int(h), int(c)) for d, w, h, c in zip(part["data"], part["width"], part["height"], part["channels"])]
            yield pd.DataFrame(
                {
                    "video": part["video"],
                    "frame_idx": part["frame_idx"],
                    "hist": [pixels.histogram(p).tolist() for p in found],
                    "lap_var": [pixels.laplacian_variance(pixels.gray(p)) for p in found],
                }
            )

    return frames.mapInPandas(run, "video string, frame_idx int, hist array<double>, lap_var double")
