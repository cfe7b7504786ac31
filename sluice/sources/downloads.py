"""Downloads into a folder: so many at a time from one host, taken up where they broke off, marked as they succeed."""

from __future__ import annotations

import hashlib
import posixpath
import re
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import MIME_SUFFIXES, url_extension
from sluice.session import ship, stored
from sluice.sources.lists import Checkpoint
from sluice.sources.pictures import CHECKS, _file_system
from sluice.sources.search_api import ATTEMPTS, DELAY, RETRY_AFTER, RETRY_STATUS, Failed, with_retry

#: Bytes that a task holds at once of what it fetches.
CHUNK = 1 << 20
RESULT = "url string, file string, bytes bigint, requests int, failure string"


def _take(system, part: str, url: str, timeout: float, sleep: Callable[[float], None]) -> str:
    """Append what is missing of a file to its part; its MIME type. A server that sends all of it instead begins it anew."""
    from pyarrow import fs

    info = system.get_file_info(part)
    have = info.size if info.type == fs.FileType.File else 0
    asked = urllib.request.Request(url, headers={"Range": f"bytes={have}-"} if have else {})
    try:
        with urllib.request.urlopen(asked, timeout=timeout) as answer:
            span = re.fullmatch(r"bytes (\d+)-\d+/(\d+)", answer.headers.get("Content-Range") or "")
            goes_on = getattr(answer, "status", None) == 206 and span is not None and int(span[1]) == have
            whole = int(span[2]) if goes_on else int(answer.headers.get("Content-Length") or -1)
            have = have if goes_on else 0
            with (system.open_append_stream if goes_on else system.open_output_stream)(part) as out:
                while some := answer.read(CHUNK):
                    out.write(some)
                    have += len(some)
            if whole not in (-1, have):
                raise Failed(0)
            return answer.headers.get_content_type()
    except urllib.error.HTTPError as error:
        if error.code == RETRY_STATUS:
            sleep(float(error.headers.get("Retry-After") or RETRY_AFTER))
        if error.code == 416:  # nothing is left to send, or the part isn't of this file
            system.delete_file(part)
        raise Failed(error.code) from error
    except (urllib.error.URLError, OSError) as error:
        raise Failed(0) from error


def _mark(done: str, items: list[str]) -> None:
    """A batch of a checkpoint, as ``Checkpoint`` writes them."""
    system, root = _file_system(done)
    at = posixpath.join(root, f"batch={uuid.uuid4().hex}")
    system.create_dir(at, recursive=True)
    rows = pa.table({"item_id": pa.array(items, pa.string()), "ts": pa.array([datetime.now(UTC)] * len(items), pa.timestamp("us", "UTC"))})
    pq.write_table(rows, posixpath.join(at, "part-0.parquet"), filesystem=system)
    system.open_output_stream(posixpath.join(at, "_SUCCESS")).close()


def _fetched(system, root: str, url: str, suffix: str | None, attempts: int, delay: float, timeout: float, sleep: Callable[[float], None] = time.sleep) -> tuple:
    """A row of the result: the file is in the folder under its name, or there is a failure."""
    stem, requests = hashlib.sha256(url.encode()).hexdigest()[:32], 0
    part = posixpath.join(root, f"{stem}.part")

    def once() -> str:
        nonlocal requests
        requests += 1
        return _take(system, part, url, timeout, sleep)

    try:
        mime = with_retry(once, 1 if url.startswith("file:") else attempts, delay, sleep=sleep)
    except Failed as failed:
        return url, None, None, requests, f"status {failed.status}" if failed.status else "no answer"
    ending = suffix or MIME_SUFFIXES.get(mime.lower())
    check = CHECKS.get({".png": "png", ".jpg": "jpeg", ".jpeg": "jpeg"}.get(ending))
    if check:
        with system.open_input_stream(part) as read:
            check = check(read.read())
    if not ending or check is False:
        system.delete_file(part)
        return url, None, None, requests, "not a whole picture" if ending else f"unknown kind {mime}"
    name = f"{stem}{ending}"
    size = system.get_file_info(part).size
    system.move(part, posixpath.join(root, name))
    return url, name, size, requests, None


def fetch_files(
    assets: DataFrame, folder: str, done: Checkpoint, task: str, url: str = "url", connections: int = 4, most_tasks: int = 64, marks: int = 20, attempts: int = ATTEMPTS, delay: float = DELAY, timeout: float = 30
) -> DataFrame:
    """(url, file, bytes, requests, failure) of every address that wasn't done: each is fetched into the folder, once.

    A file is named by a hash of its address and its suffix, by address or else
    by MIME type; one with neither fails, and so does a PNG or JPEG file that
    isn't whole. At most ``connections`` requests go to one host at a time: its
    addresses are dealt to as many tasks. Files go to the folder in chunks. What
    breaks off stays as a part, and the next attempt, be it of this run or of
    one after it, asks for the rest of it, where the server and the folder's
    file system can do that. A task marks what succeeded after every ``marks``
    files, so a job that dies loses no more than that, and those are fetched
    again. Null and repeated addresses are left out. Don't run it with
    speculation: two attempts would write one part.
    """
    ship(assets.sparkSession)
    known = done.load(task).select(F.col("item_id").alias("url"))
    asked = assets.where(F.col(url).isNotNull()).select(F.col(url).cast("string").alias("url")).distinct().join(known, "url", "left_anti")
    host = F.coalesce(F.parse_url("url", F.lit("HOST")), F.lit(""))
    dealt = asked.withColumn("suffix", url_extension("url")).repartition(most_tasks, host, F.pmod(F.xxhash64("url"), F.lit(connections)))
    marked = done.folder(task)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, root = _file_system(folder)
        system.create_dir(root, recursive=True)
        got: list[str] = []
        try:
            for rows in parts:
                results = []
                for address, suffix in zip(rows["url"], rows["suffix"]):
                    results.append(_fetched(system, root, address, suffix, attempts, delay, timeout))
                    if results[-1][-1] is None:
                        got.append(address)
                    if len(got) >= marks:
                        _mark(marked, got)
                        got = []
                yield pd.DataFrame(results, columns=["url", "file", "bytes", "requests", "failure"])
        finally:
            if got:
                _mark(marked, got)

    return stored(dealt.mapInPandas(run, RESULT))
