"""Pictures and frames as files: encoding, resizing, fetching, and a sink that writes one file for each row."""

from __future__ import annotations

import json
import posixpath
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from sluice.functions import pixels
from sluice.functions.jpeg import complete_jpeg, jpeg
from sluice.functions.text import mime_extension, output_name, url_extension
from sluice.session import ship
from sluice.sources.files import picture
from sluice.sources.search_api import fetch_bytes

#: What every frame is resized to.
FRAME_WIDTH, FRAME_HEIGHT = 1920, 1080
JPEG_SUFFIXES = (".jpg", ".jpeg")


def png(shown: np.ndarray) -> bytes:
    """A picture of blue, green and red as a PNG file, which loses nothing."""
    height, width, _ = shown.shape
    raw = np.zeros((height, 1 + 3 * width), np.uint8)
    raw[:, 1:] = shown[..., ::-1].reshape(height, -1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw.tobytes(), 6)) + chunk(b"IEND", b"")


def _encoded(rows: DataFrame, height: int | None, width: int | None, larger_only: bool) -> DataFrame:
    """(name, content): rows (name, width, height, channels, data) as files of their suffix, resized where asked for; rows without data go."""
    ship(rows.sparkSession)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            files = []
            for name, w, h, c, data in zip(part["name"], part["width"], part["height"], part["channels"], part["data"]):
                shown = picture(data, int(w), int(h), int(c))
                if height and width and (not larger_only or h > height or w > width):
                    shown = pixels.resized_picture(shown, height, width)
                files.append(jpeg(shown) if name and name.lower().endswith(JPEG_SUFFIXES) else png(shown))
            yield pd.DataFrame({"name": part["name"], "content": files})

    return rows.where(F.col("data").isNotNull()).select("name", "width", "height", "channels", "data").mapInPandas(run, "name string, content binary")


def _suffix(kind: str) -> str:
    if kind not in ("png", "jpeg"):
        raise ValueError(f"pictures are written as png or jpeg, not {kind}")
    return ".png" if kind == "png" else ".jpg"


def encoded_images(images: DataFrame, max_width: int = FRAME_WIDTH, max_height: int = FRAME_HEIGHT, kind: str = "png") -> DataFrame:
    """(name, content) of decoded images: <parent>_<file>; what exceeds the largest size becomes just that size.

    They become PNG files, or JPEG files of quality 95. With ``kind="own"`` JPEG
    files stay what they are and keep their names, all others become PNG files.
    """
    name = output_name("path")
    bare = F.regexp_replace(name, r"\.[^.]*$", "")
    if kind == "own":
        suffix = F.regexp_extract(name, r"\.[^.]*$", 0)
        name = F.when(F.lower(suffix).isin(*JPEG_SUFFIXES), name).otherwise(F.concat(bare, F.lit(".png")))
    else:
        name = F.concat(bare, F.lit(_suffix(kind)))
    return _encoded(images.withColumn("name", name), max_height, max_width, True)


def encoded_frames(frames: DataFrame, name: str = "name", kind: str = "png") -> DataFrame:
    """(name, content) of decoded keyframes with their names; every frame is resized to the one size, smaller ones too. As PNG, or JPEG of quality 95."""
    return _encoded(frames.withColumn("name", F.regexp_replace(F.col(name), r"\.[^.]*$", _suffix(kind))), FRAME_HEIGHT, FRAME_WIDTH, False)


def downloads(assets: DataFrame, url: str = "url", fetch: Callable[[str], tuple[bytes, str] | None] = fetch_bytes) -> DataFrame:
    """The assets with ``content`` and ``extension``: by address, else by MIME type; rows that can't be fetched, or are neither, have none.

    Plan what is fetched first: each row is one request. Addresses that are done are left out by ``acquire.resume``.
    """
    ship(assets.sparkSession)
    asked = assets.withColumn("_id", F.monotonically_increasing_id())

    @F.pandas_udf("struct<content: binary, mime: string>")
    def answer(addresses: pd.Series) -> pd.DataFrame:
        found = [(a and fetch(a)) or (None, None) for a in addresses]
        return pd.DataFrame(found, columns=["content", "mime"])

    got = asked.withColumn("_got", answer(F.col(url)))
    ending = F.coalesce(url_extension(url), mime_extension("_got.mime"))
    return got.select(*assets.columns, F.when(ending.isNotNull(), F.col("_got.content")).alias("content"), ending.alias("extension"))


def complete_png(content: bytes) -> bool:
    """Whether a PNG file is whole: every chunk's sum is right, and the rows are as many bytes as its head says."""
    content = bytes(content)
    if content[:8] != b"\x89PNG\r\n\x1a\n":
        return False
    at, packed, head = 8, [], b""
    while at + 12 <= len(content):
        size, kind = struct.unpack(">I4s", content[at : at + 8])
        data = content[at + 8 : at + 8 + size]
        if len(data) < size or content[at + 8 + size : at + 12 + size] != struct.pack(">I", zlib.crc32(kind + data)):
            return False
        at += 12 + size
        head = data if kind == b"IHDR" else head
        if kind == b"IDAT":
            packed.append(data)
        if kind == b"IEND":
            break
    else:
        return False
    width, height, depth, colours = struct.unpack(">IIBB", head[:10]) if len(head) == 13 else (0, 0, 0, -1)
    samples = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}.get(colours)
    if not samples or head[12]:  # interlaced pictures are left to a decoder
        return bool(samples)
    try:
        return len(zlib.decompress(b"".join(packed))) == height * (1 + (width * samples * depth + 7) // 8)
    except zlib.error:
        return False


#: What a sink can verify files as.
CHECKS: dict[str, Callable[[bytes], bool]] = {
    "png": complete_png,
    "jpeg": complete_jpeg,
    "picture": lambda content: complete_png(content) or complete_jpeg(content),
}


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


#: What a task has written, a name in each line, beside its files.
MANIFEST = "names"


@dataclass
class Written(WriterCommitMessage):
    """A task's folder and how many files are in it: all that the driver is told."""

    folder: str
    files: int
    rejected: int


class FileWriter(DataSourceWriter):
    """Each attempt of a task writes its files and their names into a folder of its own; which folders count is for the commit to say."""

    def __init__(self, folder: str, verify: Callable[[bytes], bool] | None):
        self.folder, self.verify = folder, verify

    def write(self, rows: Iterator) -> Written:
        from pyspark import TaskContext

        system, root = _file_system(self.folder)
        context = TaskContext.get()
        own = f"{context.partitionId() if context else 0}-{context.taskAttemptId() if context else 0}"
        at = posixpath.join(root, own)
        system.create_dir(at, recursive=True)
        files = rejected = 0
        with system.open_output_stream(posixpath.join(at, MANIFEST)) as names:
            for row in rows:
                name = posixpath.basename(row["name"] or "")
                if not name or row["content"] is None:
                    continue
                if self.verify and not self.verify(row["content"]):
                    rejected += 1
                    continue
                with system.open_output_stream(posixpath.join(at, f"{files}.part")) as out:
                    out.write(bytes(row["content"]))
                names.write(json.dumps(name).encode() + b"\n")
                files += 1
        return Written(own, files, rejected)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _file_system(self.folder)
        done = [(m.folder, m.files, m.rejected) for m in messages if m]
        with system.open_output_stream(posixpath.join(root, "committed")) as out:
            out.write(json.dumps(done).encode())

    def abort(self, messages: list[Written | None]) -> None:
        _remove(self.folder)


def _remove(folder: str) -> None:
    from pyarrow import fs

    system, root = _file_system(folder)
    if system.get_file_info(root).type == fs.FileType.Directory:
        system.delete_dir(root)


class FileSink(DataSource):
    """Rows (name, content) as numbered files in a folder for each task, with their names beside them; ``write_files`` gives them those names. Option: path."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "name string, content binary"

    def writer(self, schema, overwrite: bool) -> FileWriter:
        return FileWriter(self.options["path"], CHECKS.get(self.options.get("verify")))


def write_files(rows: DataFrame, folder: str, verify: str = "") -> tuple[int, int]:
    """Write (name, content) as files; (how many, how many were rejected). Sources are never touched.

    One job writes the files of each task aside, a second one gives them their
    names, task by task; the driver knows tasks and counts only. A task that
    runs twice or fails leaves nothing, and moving is safe to repeat. Two rows
    with one name are an error, and then nothing is written; a file that was
    there before is replaced. With ``verify`` as "png", "jpeg" or "picture" (one
    of both) what isn't a whole file of that kind is left out. Rows without a
    name or content are none.
    """
    if verify and verify not in CHECKS:
        raise ValueError(f"files can be verified as {', '.join(CHECKS)}, not {verify}")
    spark = rows.sparkSession
    ship(spark)
    spark.dataSource.register(FileSink)
    aside = f"{folder.rstrip('/')}/_unfinished-{uuid.uuid4().hex}"
    try:
        rows.select("name", "content").write.format("named_files").mode("append").option("path", aside).option("verify", verify).save()
        system, root = _file_system(aside)
        with system.open_input_stream(posixpath.join(root, "committed")) as said:
            done = json.loads(said.read())
        tasks = [(own, files) for own, files, _ in done if files]
        if tasks:
            _move(spark.createDataFrame(tasks, "own string, files long").repartition(len(tasks)), aside, folder)
    finally:
        _remove(aside)
    return sum(files for _, files, _ in done), sum(rejected for *_, rejected in done)


def _move(tasks: DataFrame, aside: str, folder: str) -> None:
    def names_of(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _file_system(aside)
        for part in parts:
            for own in part["own"]:
                with system.open_input_stream(posixpath.join(root, own, MANIFEST)) as said:
                    names = [json.loads(line) for line in said.read().splitlines()]
                yield pd.DataFrame({"own": own, "file": range(len(names)), "name": names})

    def move(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        (system, root), (_, out) = _file_system(aside), _file_system(folder)
        for part in parts:
            for own, file, name in zip(part["own"], part["file"], part["name"]):
                source = posixpath.join(root, own, f"{file}.part")
                if system.get_file_info(source).type == fs.FileType.File:  # else an attempt before this one has moved it
                    system.move(source, posixpath.join(out, name))
            yield pd.DataFrame({"moved": [len(part)]})

    named = tasks.mapInPandas(names_of, "own string, file long, name string")
    twice = [r["name"] for r in named.groupBy("name").count().where("count > 1").limit(3).collect()]
    if twice:
        raise ValueError(f"several rows have one name: {', '.join(twice)}")
    named.mapInPandas(move, "moved long").agg(F.sum("moved")).collect()
