"""Prompts, proxies, checkpoints, settings and reports."""

from __future__ import annotations

import contextlib
import json
import os
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.text import strip


def read_prompts(spark: SparkSession, path: str) -> DataFrame:
    """(idx, prompt) of a JSON list, or of an object's list ``prompts``; any other shape raises."""
    text = spark.read.text(path, wholetext=True)
    plain = F.from_json("value", "array<string>")
    held = F.from_json("value", "prompts array<string>").getField("prompts")
    kind = F.left(strip("value"), F.lit(1))
    found = F.when(kind == "[", plain).otherwise(held)
    sound = F.when(found.isNotNull(), found).otherwise(F.raise_error(F.lit("prompts: expected a list or an object with a list 'prompts'")))
    return text.select(F.posexplode(sound).alias("idx", "prompt"))


def read_proxies(spark: SparkSession, path: str) -> DataFrame:
    """One proxy a line; blank lines and lines with # at their start are skipped; a missing file has none."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "proxy string")
    lines = spark.read.text(path).select(strip("value").alias("proxy"))
    return lines.where((F.col("proxy") != "") & ~F.col("proxy").startswith("#"))


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


class Checkpoint:
    """Completed items of tasks: a table that is only ever added to; reading makes it a set.

    Every append is a folder of its own, <path>/task_name=<task>/batch=<id>, so
    writers never meet. Batches of like size are merged when there are more than
    ``most_batches`` of them: an item is rewritten as often as the table grows
    sixteenfold, and a load reads a number of files that hardly grows. Because
    reading makes a set, two writers may add the same items, a merge that dies
    before it deletes loses nothing, and the same batches may be merged twice.
    What a writer that died has left counts as far as it is there. A job that
    reads while another merges may find a file gone, fails and is to be run again.
    """

    SCHEMA = "item_id string, ts timestamp, task_name string"
    #: A merged batch of this many bytes is never rewritten.
    LARGE = 128 << 20

    def __init__(self, spark: SparkSession, path: str, most_batches: int = 32):
        self.spark, self.path, self.most_batches = spark, path, most_batches

    def _rows(self, task: str | None = None, batches: list[str] | None = None) -> DataFrame:
        if not _exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.SCHEMA)
        rows = self.spark.read.schema(self.SCHEMA).option("basePath", self.path).parquet(*(batches or [self.path]))
        return rows if task is None else rows.where(F.col("task_name") == task)

    def load(self, task: str | None = None) -> DataFrame:
        """(task_name, item_id, ts) of a task or of all, each item once, with its first time."""
        return self._rows(task).groupBy("task_name", "item_id").agg(F.min("ts").alias("ts"))

    def add(self, task: str, items: DataFrame, item: str = "item_id") -> None:
        """Append the items that aren't there yet. Items without an id are never done.

        What is there is cut to the items that are asked for first: where those
        are few they go to the table, which isn't shuffled.
        """
        if not task:
            raise ValueError("a task needs a name")
        asked = items.select(F.col(item).cast("string").alias("item_id")).where("item_id is not null").distinct()
        known = self._rows(task).select("item_id").join(asked, "item_id", "left_semi")
        new = asked.join(known, "item_id", "left_anti")
        self._append(task, new.select("item_id", F.current_timestamp().alias("ts")))
        self.compact(task)

    def _target(self, path: str):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target, target.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def folder(self, task: str) -> str:
        """Where the task's batches are."""
        part = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString("task_name", task)
        return f"{self.path.rstrip('/')}/{part}"

    def _append(self, task: str, rows: DataFrame) -> None:
        rows.write.parquet(f"{self.folder(task)}/batch={uuid.uuid4().hex}")

    def batches(self, task: str) -> dict[str, int]:
        """The task's finished batches and their bytes; one that is still being written isn't among them."""
        target, system = self._target(self.folder(task))
        folders = [f.getPath() for f in system.listStatus(target)] if system.exists(target) else []
        finished = [f.toString() for f in folders if system.exists(self._target(f"{f.toString()}/_SUCCESS")[0])]
        return {f: system.getContentSummary(self._target(f)[0]).getLength() for f in finished}

    def compact(self, task: str) -> None:
        """Merge the task's batches of like size where there are too many of them; ``add`` does so by itself."""
        tiers: dict[int, list[str]] = {}
        sizes = self.batches(task)
        for path, size in sizes.items():
            if size < self.LARGE:
                tiers.setdefault(size.bit_length() // 4, []).append(path)
        for paths in tiers.values():
            if len(paths) > self.most_batches:
                merged = self._rows(batches=paths).groupBy("item_id").agg(F.min("ts").alias("ts"))
                self._append(task, merged.coalesce(1 + sum(sizes[p] for p in paths) // self.LARGE))
                for path in paths:
                    self._delete(path)

    def _delete(self, path: str) -> None:
        target, system = self._target(path)
        system.delete(target, True)

    def discard(self) -> None:
        """Delete the table; a session that is gone is no error."""
        with contextlib.suppress(Exception):
            self.clear()

    def clear(self, task: str | None = None) -> None:
        """Forget the items of a task, or all."""
        self._delete(self.path if task is None else self.folder(task))


def load_checkpoint_json(spark: SparkSession, path: str) -> DataFrame:
    """(task_name, item_id) of a JSON checkpoint; corrupt or missing ones have no rows."""
    if not _exists(spark, path):
        return spark.createDataFrame([], "task_name string, item_id string")
    read = spark.read.schema("timestamp string, task_name string, data struct<completed: array<string>>").json(path, multiLine=True)
    return read.select("task_name", F.explode("data.completed").alias("item_id"))


def write_report(row: DataFrame, path: str) -> None:
    """A report as one JSON file."""
    row.coalesce(1).write.mode("overwrite").json(path)


def _yaml():
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("settings in YAML need the yaml module; use JSON without it") from error
    return yaml


@dataclass
class Settings:
    """Settings with their defaults, from JSON or YAML; environment variables win over the file where they aren't empty."""

    sharpness: float = 100.0
    scene_change: float = 30.0
    hamming: int = 8
    similarity: float = 0.25
    min_size: tuple[int, int] = (480, 360)
    max_size: tuple[int, int] = (1920, 1080)
    retries: int = 3
    retry_delay: float = 1.0
    keys: dict[str, str] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str | None = None, env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ) if env is None else env
        given = {}
        if path and os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                given = _yaml().safe_load(f) or {} if path.endswith((".yaml", ".yml")) else json.load(f)
        unknown = set(given) - set(cls.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        made = cls(**given)
        made.min_size, made.max_size = tuple(made.min_size), tuple(made.max_size)
        for name in ("unsplash", "pexels", "flickr"):
            if key := env.get(f"{name.upper()}_API_KEY"):
                made.keys[name] = key
        return made

    def save(self, path: str) -> None:
        given = asdict(self) | {"min_size": list(self.min_size), "max_size": list(self.max_size)}
        with open(path, "w", encoding="utf-8") as f:
            if path.endswith((".yaml", ".yml")):
                _yaml().safe_dump(given, f, allow_unicode=True, sort_keys=False)
            else:
                json.dump(given, f, indent=2)
