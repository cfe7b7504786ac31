"""Sessions, table loading and shared scratch space."""

from __future__ import annotations

import atexit
import contextlib
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("sluice")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


#: Rows that go to a Python worker at once: texts are long, and two copies of a batch are held.
BATCH_ROWS = "2000"
_BATCHES = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Let executors import this package wherever the driver found it: once for each application, by the driver's file server.

    Batches to Python workers become smaller unless the session has a size of its own.
    """
    sc = spark.sparkContext
    if spark.conf.get(_BATCHES) == "10000" and not sc.getConf().contains(_BATCHES):
        spark.conf.set(_BATCHES, BATCH_ROWS)
    if sc.applicationId in _SHIPPED:
        return
    here = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="sluice-ship-")) / "sluice-package.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for path in sorted(here.rglob("*.py")):
            archive.write(path, path.relative_to(here.parent))
    sc.addPyFile(str(target))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a private one where that is unset and all is one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return folder or os.path.join(tempfile.gettempdir(), f"sluice-checkpoints-{os.getpid()}")


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder, which is smaller than a checkpoint of wide rows.

    The table is deleted by ``free``, or else when the application ends; copies of it in memory hold no rows.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/sluice-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_delete, spark, path)
    out = spark.read.parquet(path)
    out._sluice_path = path
    return out


def stored_one_by_one(frames: Iterable[DataFrame]) -> DataFrame | None:
    """One table of several results of one schema, each written before the next one is asked for, so that only one is held at a time; None without any."""
    path, spark, several = "", None, 0
    for several, df in enumerate(frames, 1):
        if not spark:
            spark = df.sparkSession
            path = f"{shared_folder(spark).rstrip('/')}/sluice-{uuid.uuid4().hex}"
            atexit.register(_delete, spark, path)
        df.write.parquet(f"{path}/{several}")
    if not spark:
        return None
    out = spark.read.option("recursiveFileLookup", "true").parquet(path)
    out._sluice_path = path
    return out


def free(df: DataFrame) -> None:
    """Delete the table behind a result of ``stored`` that nothing will read any more; other DataFrames are left alone."""
    path = getattr(df, "_sluice_path", None)
    if path:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may be gone
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session; a private folder is made
    only where it is unset, as in local tests.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
