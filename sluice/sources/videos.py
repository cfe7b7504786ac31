"""Uncompressed videos as tables of frames: an index of each file, then ranges of frames in tasks of their own."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import ship
from sluice.sources.pictures import _file_system

INDEX = "path string, frame_idx int, offset bigint, width int, height int, layout string, failure string"
FRAMES = "video string, frame_idx int, width int, height int, channels int, data binary"
#: Places of colour for one of brightness, across and down.
CHROMA = {"420": (2, 2), "422": (2, 1), "444": (1, 1), "mono": (0, 0)}
#: The longest line in front of a frame.
LINE = 256


class Unreadable(Exception):
    """Why a file has no frames for us."""


def _plane_sizes(layout: str, width: int, height: int) -> tuple[int, int, int]:
    """(rows and columns of a colour plane, bytes of a frame) of a planar layout."""
    across, down = CHROMA[layout]
    rows, columns = (-(-height // down), -(-width // across)) if across else (0, 0)
    return rows, columns, width * height + 2 * rows * columns


def _y4m(read, size: int) -> tuple[int, int, str, list[int]]:
    """(width, height, layout, where frames begin) of planes behind lines of text. A frame that is cut off is none."""
    head = read.read(LINE).split(b"\n")[0].decode("latin-1").split(" ")
    said = {word[0]: word[1:] for word in head[1:] if word}
    layout = next((name for name in CHROMA if said.get("C", "420").startswith(name)), "")
    if not layout or "p1" in said.get("C", "") or not (said.get("W", "").isdigit() and said.get("H", "").isdigit()):
        raise Unreadable(f"layout {said.get('C', '?')}")
    width, height = int(said["W"]), int(said["H"])
    stride = _plane_sizes(layout, width, height)[2]
    at, offsets = len(" ".join(head)) + 1, []
    while at + stride < size:
        read.seek(at)
        line = read.read(LINE).split(b"\n")[0]
        if not line.startswith(b"FRAME") or at + len(line) + 1 + stride > size:
            break
        offsets.append(at + len(line) + 1)
        at = offsets[-1] + stride
    return width, height, layout, offsets


def _avi(read, size: int) -> tuple[int, int, str, list[int]]:
    """The same of a tree of chunks whose first video stream is of plain blue, green and red. An empty chunk shows the frame before it again."""
    at, streams, video, shape, offsets = 0, 0, None, None, []
    while at + 8 <= size:
        read.seek(at)
        kind, length = struct.unpack("<4sI", read.read(8))
        if kind in (b"RIFF", b"LIST"):
            at += 12
            continue
        if at + 8 + length > size:
            break
        if kind == b"strh":
            if video is None and read.read(4) == b"vids":
                video = streams
            streams += 1
        elif kind == b"strf" and video == streams - 1 and shape is None and length >= 40:
            _, width, height, _, bits, packing = struct.unpack("<IiiHHI", read.read(20))
            if packing or bits not in (24, 32):
                raise Unreadable(f"compression {struct.pack('<I', packing)!r} of {bits} bits")
            shape = width, abs(height), f"bgr{bits}{'' if height > 0 else 'down'}"
        elif shape and kind in (b"%02ddb" % video, b"%02ddc" % video):
            if length:
                offsets.append(at + 8)
            elif offsets:
                offsets.append(offsets[-1])
        at += 8 + length + length % 2
    if shape is None:
        raise Unreadable("no video stream")
    return *shape, offsets


def _picture(data: bytes, width: int, height: int, layout: str) -> np.ndarray:
    """Rows of blue, green and red of a frame as its file has it."""
    raw = np.frombuffer(data, np.uint8)
    if layout.startswith("bgr"):
        depth = int(layout[3:5]) // 8
        rows = raw.reshape(height, -1)[:, : width * depth].reshape(height, width, depth)[..., :3]
        return rows if layout.endswith("down") else rows[::-1]
    rows, columns, _ = _plane_sizes(layout, width, height)
    light = 1.164383 * (raw[: width * height].reshape(height, width) - 16.0)
    if not rows:
        shown = np.repeat(light[..., None], 3, axis=2)
    else:
        across, down = CHROMA[layout]
        u, v = (p.repeat(down, 0).repeat(across, 1)[:height, :width] - 128.0 for p in raw[width * height :].reshape(2, rows, columns))
        shown = np.stack([light + 2.017232 * u, light - 0.391762 * u - 0.812968 * v, light + 1.596027 * v], -1)
    return np.clip(np.rint(shown), 0, 255).astype(np.uint8)


def _frame_bytes(layout: str, width: int, height: int) -> int:
    if layout.startswith("bgr"):
        return height * -(-width * int(layout[3:5]) // 32) * 4
    return _plane_sizes(layout, width, height)[2]


def video_index(spark: SparkSession, folder: str) -> DataFrame:
    """(path, frame_idx, offset, width, height, layout, failure) of every frame of the .y4m and .avi files of a folder.

    Only headers are read, a file in one task. A file that can't be read, as one
    whose frames are compressed, is one row without a frame that says why; those
    need a decoder, which the box lacks. A file without frames or without any
    bytes has no rows.
    """
    ship(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    wanted = files.where(F.lower("path").rlike(r"\.(y4m|avi)$"))

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, size in zip(part["path"], part["length"]):
                system, at = _file_system(path)
                try:
                    with system.open_input_file(at) as read:
                        start = read.read(10)
                        read.seek(0)
                        if start.startswith(b"YUV4MPEG2 "):
                            width, height, layout, offsets = _y4m(read, int(size))
                        elif start.startswith(b"RIFF"):
                            width, height, layout, offsets = _avi(read, int(size))
                        else:
                            raise Unreadable("neither y4m nor avi")
                    rows = [(path, n, offset, width, height, layout, None) for n, offset in enumerate(offsets)]
                except (Unreadable, struct.error) as error:
                    rows = [(path, None, None, None, None, None, str(error))]
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in INDEX.split(", ")], dtype=object)

    return wanted.repartition("path").mapInPandas(run, INDEX)


def read_frames(index: DataFrame, frames_per_task: int = 64) -> DataFrame:
    """(video, frame_idx, width, height, channels, data) of an index's frames, as ``files.frame_features`` takes them.

    A video's frames are read in ranges, which are dealt to tasks, so a long one
    spans many. The video is the file's name without its suffix.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, own in part.sort_values(["path", "frame_idx"]).groupby("path"):
                system, at = _file_system(path)
                with system.open_input_file(at) as read:
                    for n, offset, w, h, layout, video in zip(own["frame_idx"], own["offset"], own["width"], own["height"], own["layout"], own["video"]):
                        read.seek(int(offset))
                        shown = _picture(read.read(_frame_bytes(layout, int(w), int(h))), int(w), int(h), layout)
                        yield pd.DataFrame({"video": [video], "frame_idx": [n], "width": [w], "height": [h], "channels": [3], "data": [shown.tobytes()]})

    found = index.where("offset is not null").withColumn("video", F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.[^.]*$", ""))
    return found.repartition("path", F.floor(F.col("frame_idx") / frames_per_task)).mapInPandas(run, FRAMES)
