import threading
import time
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import numpy as np
import pytest

from sluice.functions.jpeg import jpeg
from sluice.sources.downloads import fetch_files
from sluice.sources.lists import Checkpoint
from sluice.sources.pictures import png

SHOWN = np.random.default_rng(1).integers(0, 256, (90, 110, 3)).astype(np.uint8)
PNG, JPEG = png(SHOWN), jpeg(SHOWN)


class Site(BaseHTTPRequestHandler):
    """Breaks off what begins with /broken after half of what was asked for, so often as it has to; knows ranges unless told otherwise."""

    asked, ranges, broken, busy, most = Counter(), [], 0, 0, 0
    lock = threading.Lock()

    def do_GET(self):
        with Site.lock:
            Site.asked[self.path] += 1
            Site.busy += 1
            Site.most = max(Site.most, Site.busy)
            breaks = self.path.startswith("/broken") and Site.broken > 0
            Site.broken -= breaks
        try:
            if self.path.startswith("/slow"):
                time.sleep(0.15)
            if self.path.startswith("/gone"):
                return self.send_error(404)
            if self.path.startswith("/weak") and Site.asked[self.path] < 3:
                return self.send_error(503)
            body = {"jpg": JPEG, "bad.png": PNG[:-9], "text": b"words"}.get(self.path.rsplit("/")[-1], JPEG if self.path.endswith(".jpg") else PNG)
            since = int((self.headers.get("Range") or "bytes=0-")[6:-1])
            if since and "whole" in self.path:
                since = 0
            self.send_response(206 if since else 200)
            if since:
                Site.ranges.append(since)
                self.send_header("Content-Range", f"bytes {since}-{len(body) - 1}/{len(body)}")
            self.send_header("Content-Type", "text/plain" if self.path.endswith("text") else "image/jpeg" if body is JPEG else "image/png")
            self.send_header("Content-Length", str(len(body) - since))
            self.end_headers()
            self.wfile.write(body[since : since + (len(body) - since) // 2] if breaks else body[since:])
        finally:
            with Site.lock:
                Site.busy -= 1

    def log_message(self, *_):
        pass


@pytest.fixture
def site():
    Site.asked, Site.ranges, Site.broken, Site.busy, Site.most = Counter(), [], 0, 0, 0
    server = ThreadingHTTPServer(("127.0.0.1", 0), Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def fetch(spark, tmp_path, urls, **how):
    done = Checkpoint(spark, str(tmp_path / "done"))
    rows = fetch_files(spark.createDataFrame([(u,) for u in urls], "url string"), str(tmp_path / "out"), done, "t", delay=0.01, **how).collect()
    return {r["url"].split("/", 3)[3]: r for r in rows}, {r["item_id"].split("/", 3)[3] for r in done.load("t").collect()}


def test_what_succeeds_is_whole_and_marked_and_what_fails_says_why(spark, tmp_path, site):
    names = ["a.png", "b.jpg", "c/jpg", "bad.png", "text", "gone.png", "weak.png", "a.png"]
    found, marked = fetch(spark, tmp_path, [*(f"{site}/{n}" for n in names), None])
    assert marked == {"a.png", "b.jpg", "c/jpg", "weak.png"}
    assert {n: r["failure"] for n, r in found.items() if r["failure"]} == {"bad.png": "not a whole picture", "text": "unknown kind text/plain", "gone.png": "status 404"}
    assert (tmp_path / "out" / found["a.png"]["file"]).read_bytes() == PNG and found["c/jpg"]["file"].endswith(".jpg")
    assert found["weak.png"]["requests"] == 3 and found["b.jpg"]["bytes"] == len(JPEG)
    assert sorted(p.name for p in (tmp_path / "out").glob("[!.]*")) == sorted(r["file"] for r in found.values() if r["file"])
    again, marked = fetch(spark, tmp_path, [f"{site}/{n}" for n in names])
    assert set(again) == {"bad.png", "text", "gone.png"} and Site.asked["/a.png"] == 1


def test_a_broken_download_is_completed_by_the_next_attempt_and_the_next_run(spark, tmp_path, site):
    Site.broken = 4
    found, marked = fetch(spark, tmp_path, [f"{site}/broken.png"], attempts=3)
    assert found["broken.png"]["failure"] == "no answer" and not marked and len(Site.ranges) == 2
    found, marked = fetch(spark, tmp_path, [f"{site}/broken.png"], attempts=3)
    assert marked == {"broken.png"} and (tmp_path / "out" / found["broken.png"]["file"]).read_bytes() == PNG
    assert Site.ranges == sorted(Site.ranges) and len(Site.ranges) == 4 and Site.ranges[-1] > len(PNG) * 0.9


def test_a_server_without_ranges_sends_all_again(spark, tmp_path, site):
    Site.broken = 1
    found, marked = fetch(spark, tmp_path, [f"{site}/broken-whole.png"])
    assert marked and not Site.ranges and (tmp_path / "out" / found["broken-whole.png"]["file"]).read_bytes() == PNG


def test_one_host_gets_so_many_requests_at_a_time(spark, tmp_path, site):
    found, marked = fetch(spark, tmp_path, [f"{site}/slow{k}.png" for k in range(24)], connections=2, most_tasks=8, marks=5)
    assert len(found) == len(marked) == 24 and Site.most <= 2
