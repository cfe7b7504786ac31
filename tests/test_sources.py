import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.functions import pixels
from sluice.operators import acquire
from sluice.sources import files, lists, pictures, records, web
from sluice.sources import search_api
from sluice.sources.search_api import Gate, SearchSource, with_retry
from sluice.streaming import live


def png(path, pixels):
    h, w, _ = pixels.shape
    raw = b"".join(b"\0" + row.tobytes() for row in pixels[..., ::-1])

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def test_images_end_to_end(spark, tmp_path):
    (tmp_path / "a").mkdir()
    blue = np.zeros((20, 30, 3), np.uint8)
    blue[..., 0] = 200
    png(tmp_path / "a" / "x.PNG", blue)
    (tmp_path / "a" / "bad.jpg").write_bytes(b"not a jpg!")
    (tmp_path / "note.txt").write_text("x")
    assert files.scan_images(spark, str(tmp_path)).count() == 2
    assert files.scan_videos(spark, str(tmp_path)).count() == 0
    rows = {r["path"].rsplit("/", 1)[1]: r for r in files.image_features(files.read_images(spark, str(tmp_path / "a"))).collect()}
    assert rows["bad.jpg"]["width"] is None
    assert (rows["x.PNG"]["width"], rows["x.PNG"]["height"], rows["x.PNG"]["lap_var"], rows["x.PNG"]["blue"]) == (30, 20, 0.0, 1.0)


BODIES = {
    "unsplash": {"total": 3, "results": [{"id": "a", "width": 1, "urls": {"regular": "", "full": "http://f"}, "alt_description": "d", "user": {"name": "n"}}, {"id": "b", "urls": {}}]},
    "pexels": {"total_results": 9, "photos": [{"id": 5, "src": {"large": "http://l"}, "alt": "t", "photographer": "p"}]},
    "flickr": {"stat": "ok", "photos": {"pages": 4, "photo": [{"id": "7", "server": "1", "secret": "s", "license": "42"}, {"id": "8", "url_o": "http://o", "license": "10"}]}},
    "wikimedia": {"continue": {"c": "x"}, "query": {"pages": {"11": {"imageinfo": [{"url": "http://w", "extmetadata": {"Artist": {"value": "x" * 150}}}]}, "12": {}}}},
}


@pytest.mark.parametrize(
    "source, urls, pages",
    [("unsplash", ["http://f"], 1), ("pexels", ["http://l"], 1), ("flickr", ["https://live.staticflickr.com/1/7_s_b.jpg", "http://o"], 4), ("wikimedia", ["http://w"], 999)],
)
def test_records(spark, source, urls, pages):
    raw = spark.createDataFrame([("k", 1, json.dumps(BODIES[source])), ("k", 2, "junk")], "keyword string, page int, body string")
    found = records.parse(raw, source).orderBy("pos").collect()
    assert [r["url"] for r in found] == urls and found[0].asDict().keys() == set(records.RECORD)
    assert records.total_pages(raw, source, 30).first()["pages"] == pages
    if source == "flickr":
        assert [r["license"] for r in found] == ["Unknown", "Public Domain Mark"]
    if source == "wikimedia":
        assert len(found[0]["author"]) == 100 and found[0]["license"] == "Wikimedia Commons"


def test_failed_flickr_page_has_no_records(spark):
    raw = spark.createDataFrame([("k", 1, json.dumps({**BODIES["flickr"], "stat": "fail"}))], "keyword string, page int, body string")
    assert records.parse(raw, "flickr").count() == 0


def test_web(spark):
    html = 'mediaurl=http%3A%2F%2Fx%2Fa+b.jpg" mediaurl=ftp%3A%2F%2Fx.jpg" ["https://y/c.png\\u003d1",600,800] mediaurl=http%3A%2F%2Fx%2Fa+b.jpg"'
    pages = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    assert [r["url"] for r in web.listed_urls(pages).orderBy("pos").collect()] == ["http://x/a+b.jpg", "https://y/c.png=1"]
    search = '<a class="card-image" href="/one"></a><img src="/t_th.jpg"><img data-src="/u.png">'
    article = '<div class="content"><img src="icon.png"><img src="/big_med.jpg"></div><meta property="og:image" content="http://og">'
    found = web.search_images(
        spark.createDataFrame([(1, "s", search)], "page_id long, url string, html string"),
        spark.createDataFrame([(2, "https://b/one", article)], "page_id long, url string, html string"),
        "https://b",
    )
    assert [r["url"] for r in found.orderBy("place").collect()] == ["https://b/big_lrg.jpg", "https://b/t_lrg.jpg", "https://b/u.png"]


def test_lists(spark, tmp_path):
    (tmp_path / "a.json").write_text('["x", "y"]')
    (tmp_path / "b.json").write_text('{"prompts": ["z"]}')
    (tmp_path / "c.json").write_text('{"other": 1}')
    assert [r["prompt"] for r in lists.read_prompts(spark, str(tmp_path / "a.json")).orderBy("idx").collect()] == ["x", "y"]
    assert lists.read_prompts(spark, str(tmp_path / "b.json")).first()["prompt"] == "z"
    with pytest.raises(Exception, match="prompts"):
        lists.read_prompts(spark, str(tmp_path / "c.json")).collect()
    (tmp_path / "p.txt").write_text("# no\n\n http://p \n")
    assert [r["proxy"] for r in lists.read_proxies(spark, str(tmp_path / "p.txt")).collect()] == ["http://p"]
    assert lists.read_proxies(spark, str(tmp_path / "none.txt")).count() == 0
    done = lists.Checkpoint(spark, str(tmp_path / "done"))
    assert done.load().count() == 0
    done.add("t", spark.createDataFrame([("a",), ("a",)], "item_id string"))
    done.add("t", spark.createDataFrame([("a",), ("b",)], "item_id string"))
    assert {r["item_id"] for r in done.load("t").collect()} == {"a", "b"}
    done.clear()
    assert done.load().count() == 0
    (tmp_path / "old.json").write_text(json.dumps({"timestamp": "x", "task_name": "t", "data": {"completed": ["q"]}}))
    assert lists.load_checkpoint_json(spark, str(tmp_path / "old.json")).first()["item_id"] == "q"
    lists.Settings(hamming=4).save(str(tmp_path / "s.json"))
    made = lists.Settings.load(str(tmp_path / "s.json"), {"PEXELS_API_KEY": "k", "FLICKR_API_KEY": ""})
    assert made.hamming == 4 and made.keys == {"pexels": "k"} and made.min_size == (480, 360)


def test_search_source_reads_fixture_pages(spark, tmp_path):
    for page in (1, 2):
        (tmp_path / f"flood{page}.json").write_text(json.dumps(BODIES["unsplash"]))
    spark.dataSource.register(SearchSource)
    rows = spark.read.format("search_api").options(template=f"file://{tmp_path}/{{keyword}}{{page}}.json", keywords='["flood", "none"]', pages=2).load()
    assert records.parse(rows, "unsplash").count() == 2


def test_retry_waits_between_attempts_only():
    waits, calls = [], []

    def fails():
        calls.append(1)
        raise OSError

    with pytest.raises(OSError):
        with_retry(fails, 3, 1.0, sleep=waits.append)
    assert waits == [1.0, 2.0] and len(calls) == 3


def test_streams(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:10:00"), ("b", "2024-01-01 00:20:00")], "k string, at string").select(
        "k", F.col("at").cast("timestamp").alias("ts")
    ).write.parquet(folder)
    stream = live.growing_folder(spark, folder, "k string, ts timestamp")
    run = live.first_seen(stream, ["k"]).writeStream.format("memory").queryName("firsts").trigger(availableNow=True).start()
    run.awaitTermination(60)
    assert spark.sql("select count(*) as n from firsts").first()["n"] == 2
    counts = live.window_counts(stream, "k", window="1 hour", slide="1 hour")
    run = counts.writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    run.awaitTermination(60)
    assert {r["k"]: r["n"] for r in spark.sql("select * from counts").collect()} == {"a": 2, "b": 1}


def paged(spark, tmp_path, **options):
    spark.dataSource.register(SearchSource)
    return spark.read.format("search_api").options(keywords='["k"]', pages=9, **options).load().orderBy("page").collect()


def test_pages_that_name_the_next_one(spark, tmp_path):
    for name, body in (("", {"continue": {"gsroffset": 50}}), ("50", {"continue": {"gsroffset": 100}}), ("100", {"query": {}})):
        (tmp_path / f"k-{name}.json").write_text(json.dumps(body))
    rows = paged(spark, tmp_path, template=f"file://{tmp_path}/{{keyword}}-{{token}}.json", paging="cursor", cursor="continue.gsroffset")
    assert [r["page"] for r in rows] == [1, 2, 3] and "query" in rows[-1]["body"]


def test_pages_until_one_is_short(spark, tmp_path):
    full = '<a href="/x">' * 10 + '<a href="?pg=2">'
    for page, body in ((1, full), (2, full), (3, '<a href="/x"> pg='), (4, full)):
        (tmp_path / f"k{page}.html").write_text(body)
    rows = paged(spark, tmp_path, template=f"file://{tmp_path}/{{keyword}}{{page}}.html", paging="until_short")
    assert [r["page"] for r in rows] == [1, 2, 3]
    # a category's pages are read in turn whatever they hold, up to one that isn't there, which says so
    rows = paged(spark, tmp_path, template=f"file://{tmp_path}/{{keyword}}{{page}}.html", paging="all")
    assert [(r["page"], r["body"] is None, r["status"]) for r in rows] == [(1, False, None), (2, False, None), (3, False, None), (4, False, None), (5, True, 0)]


def test_the_gate_lets_so_many_go_in_any_window():
    now, went = [0.0], []

    def sleep(seconds):
        now[0] += seconds

    gate = Gate(3, 60, lambda: now[0], sleep)
    for step in (0, 1, 1, 1, 100, 0, 0, 0):
        now[0] += step
        gate.wait()
        went.append(now[0])
    assert all(b - a >= 60 for a, b in zip(went, went[3:])) and went[:3] == [0, 1, 2] and went[4:7] == [160, 160, 160]


def test_pictures_are_written_resized_and_read_again(spark, tmp_path):
    (tmp_path / "in" / "a").mkdir(parents=True)
    rnd = np.random.default_rng(0)
    small, large = rnd.integers(0, 255, (20, 30, 3), np.uint8), rnd.integers(0, 255, (40, 2000, 3), np.uint8)
    (tmp_path / "in" / "a" / "s.png").write_bytes(pictures.png(small))
    (tmp_path / "in" / "a" / "l.png").write_bytes(pictures.png(large))
    (tmp_path / "in" / "a" / "bad.png").write_bytes(b"no picture")
    images = files.read_images(spark, str(tmp_path / "in"))
    out = str(tmp_path / "out")
    pictures.write_files(pictures.encoded_images(images), out)
    found = {r["path"].rsplit("/", 1)[1]: r for r in files.read_images(spark, out).collect()}
    assert found.keys() == {"a_s.png", "a_l.png"} and (found["a_l.png"]["width"], found["a_l.png"]["height"]) == (1920, 1080)
    assert (files.picture(found["a_s.png"]["data"], 30, 20, 3) == small).all()
    frames = images.where("height = 20").selectExpr("'v_frame_00003.jpg' as name", "width", "height", "channels", "data")
    frame = pictures.encoded_frames(frames).collect()
    assert [r["name"] for r in frame] == ["v_frame_00003.png"] and struct.unpack(">II", bytes(frame[0]["content"])[16:24]) == (1920, 1080)
    assert pixels.resized_picture(small, 20, 30).shape == (20, 30, 3) and not list((tmp_path / "out").glob("_unfinished*"))


def test_downloads_resume_and_are_verified(spark, tmp_path):
    (tmp_path / "web").mkdir()
    (tmp_path / "web" / "a.png").write_bytes(pictures.png(np.zeros((2, 2, 3), np.uint8)))
    (tmp_path / "web" / "note.txt").write_text("x")
    urls = [f"file://{tmp_path}/web/{n}" for n in ("a.png", "gone.png", "note.txt", "done.png")]
    done = lists.Checkpoint(spark, str(tmp_path / "done"))
    done.add("t", spark.createDataFrame([(urls[3],)], "item_id string"))
    todo = acquire.resume(spark.createDataFrame([(u, f"n{k}.png") for k, u in enumerate(urls)] + [(None, "n9")], "item_id string, name string"), done.load("t"))
    got = {r["name"]: r for r in pictures.downloads(todo, "item_id").collect()}
    assert got.keys() == {"n0.png", "n1.png", "n2.png", "n9"} and got["n0.png"]["extension"] == ".png"
    assert [n for n, r in got.items() if r["content"] is not None] == ["n0.png"]
    pictures.write_files(spark.createDataFrame([(r["name"], r["content"]) for r in got.values()], "name string, content binary"), str(tmp_path / "got"))
    assert files.read_images(spark, str(tmp_path / "got"), drop_invalid=True).count() == 1


def test_snapshots_and_video_hits(spark):
    page = lambda *names: " ".join(f'mediaurl=http://x/{n}.jpg"' for n in names)
    rows = [("k", 0, page("a", "b")), ("k", 1, page("a", "b", "c")), ("k", 2, page("d", "a")), ("j", 0, page("a"))]
    found = web.snapshot_urls(spark.createDataFrame(rows, "keyword string, scroll int, html string"), 3).orderBy("keyword", "place").collect()
    assert [(r["keyword"], r["url"][-5]) for r in found] == [("j", "a"), ("k", "a"), ("k", "b"), ("k", "c")]
    entries = spark.createDataFrame([("k", 0, "i", "u"), ("k", 1, "i", ""), ("k", 2, None, None)], "keyword string, pos int, id string, url string")
    assert [r["url"] for r in web.video_hits(entries, "https://v/").orderBy("pos").collect()] == ["u", "https://v/i"]


def test_proxies_are_picked_marked_and_started_over(spark):
    proxies = spark.createDataFrame([(p,) for p in "abc"], "proxy string")
    none = proxies.limit(0)
    picked = {acquire.pick_proxy(proxies, none, seed).first()["proxy"] for seed in range(12)}
    assert picked == set("abc") and len({acquire.pick_proxy(proxies, none, 1).first()["proxy"] for _ in range(3)}) == 1
    failed = acquire.mark_failed(none, proxies, proxies.where("proxy <> 'c'"))
    assert acquire.pick_proxy(proxies, failed, 5).first()["proxy"] == "c"
    assert acquire.mark_failed(failed, proxies, proxies.where("proxy = 'c'")).count() == 0


def test_settings_in_yaml(tmp_path):
    pytest.importorskip("yaml")
    path = str(tmp_path / "s.yaml")
    lists.Settings(sharpness=50.0, keys={"pexels": "k"}).save(path)
    made = lists.Settings.load(path, {"PEXELS_API_KEY": "", "FLICKR_API_KEY": "f"})
    assert made.sharpness == 50.0 and made.min_size == (480, 360) and made.keys == {"pexels": "k", "flickr": "f"}


def simulated(parts, options, answers, late=lambda: 0.0, slots=2):
    """Reads the partitions in order with so many slots under a clock of its own; (when each request went, all rows)."""
    went, rows, free = [], [], [1000.0] * slots
    for part in parts:
        k = min(range(slots), key=free.__getitem__)
        now = [free[k] + late()]

        def sleep(seconds):
            now[0] += seconds + late() / 100

        def asked(request, timeout):
            went.append(now[0])
            now[0] += 0.5
            return answers(request.full_url)

        reader = search_api.SearchReader(options, lambda: now[0], sleep)
        search_api.urllib.request.urlopen, kept = asked, search_api.urllib.request.urlopen
        try:
            rows += list(reader.read(part))
        finally:
            search_api.urllib.request.urlopen = kept
        free[k] = now[0]
    return sorted(went), rows


class Body:
    headers = type("Headers", (), {"get_content_type": staticmethod(lambda: "text/html")})

    def __init__(self, said):
        self.said = said

    def read(self):
        return self.said.encode()

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False


@pytest.mark.parametrize("paging, limit", [("numbered", 3), ("numbered", 1), ("all", 4), ("numbered", 50)])
def test_all_partitions_keep_one_limit(paging, limit):
    rnd = np.random.default_rng(limit)
    options = {"template": "http://x/{keyword}/{page}", "keywords": '["a", "b", "c", "d"]', "pages": "5", "paging": paging, "limit": str(limit), "delay": "1"}
    parts = search_api.SearchReader(options, lambda: 1000.0).partitions()
    assert len(parts) == (20 if paging == "numbered" else 4)
    failures = {}

    def answers(url):
        failures[url] = failures.get(url, -1) + 1
        if "3" in url and failures[url] < 2:  # too many requests, then an error of the server
            code = [429, 503][failures[url]]
            raise search_api.urllib.error.HTTPError(url, code, "", {"Retry-After": "700"} if code == 429 else {}, None)
        return Body("ok")

    went, rows = simulated(parts, options, answers, lambda: float(rnd.exponential(200.0)))
    assert [r[2] for r in rows] == ["ok"] * 20 and len(went) == 28
    assert all(sum(t <= u < t + 3600 for u in went) <= limit for t in went)
    if limit == 50:
        assert went[11] - went[0] < 3600  # what is within the limit goes at once


def test_no_limit_no_wait_and_attempts_end():
    options = {"template": "http://x/{keyword}/{page}", "keywords": '["a"]', "pages": "3", "attempts": "2", "delay": "1"}

    def answers(url):
        raise search_api.urllib.error.HTTPError(url, 404, "", {}, None) if "2" in url else OSError("none")

    went, rows = simulated(search_api.SearchReader(options, lambda: 1000.0).partitions(), options, answers, slots=1)
    assert [r[2:] for r in rows] == [(None, 0), (None, 404), (None, 0)] and len(went) == 6 and went[-1] < 1020


def test_many_files_are_named_in_tasks(spark, tmp_path):
    whole = pictures.png(np.zeros((1, 1, 3), np.uint8))
    rows = spark.range(10_000).select(F.concat(F.lit("n"), F.col("id").cast("string"), F.lit(".png")).alias("name"), F.lit(whole).alias("content")).repartition(6)
    out = str(tmp_path / "out")
    assert pictures.write_files(rows, out, verify="png") == (10_000, 0)
    assert len(list((tmp_path / "out").iterdir())) == 10_000 and (tmp_path / "out" / "n77.png").read_bytes() == whole
    odd = spark.createDataFrame([("a.png", whole[:-3]), ("b.png", whole), (None, whole), ("", whole), ("c.png", None), ("d.png", b""), ("n1.png", whole[:40] + b"x" + whole[41:])], "name string, content binary")
    assert pictures.write_files(odd, out, verify="png") == (1, 3) and (tmp_path / "out" / "b.png").exists()
    assert pictures.write_files(odd.limit(0), out) == (0, 0)
    twice = spark.createDataFrame([("z.png", b"1"), ("z.png", b"2"), ("y.png", b"3")], "name string, content binary")
    with pytest.raises(ValueError, match=r"z\.png"):
        pictures.write_files(twice, out)
    assert not (tmp_path / "out" / "y.png").exists() and not list((tmp_path / "out").glob("_unfinished*"))


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    @F.udf("binary")
    def broken(k):
        if k == 17:
            raise ValueError("no content")
        return b"x"

    rows = spark.range(20).select(F.col("id").cast("string").alias("name"), broken("id").alias("content")).repartition(3)
    with pytest.raises(Exception, match="no content"):
        pictures.write_files(rows, str(tmp_path / "out"))
    assert not (tmp_path / "out").exists() or not list((tmp_path / "out").iterdir())


@pytest.mark.parametrize("colours, interlaced", [(2, 0), (0, 0), (6, 0), (2, 1)])
def test_whole_png_files(colours, interlaced):
    rows = b"\0" + bytes(4 * {2: 3, 0: 1, 6: 4}[colours])
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 2, 8, colours, 0, 0, interlaced))
    made = lambda n: b"\x89PNG\r\n\x1a\n" + head + chunk(b"IDAT", zlib.compress(rows * n)) + chunk(b"IEND", b"")
    assert pictures.complete_png(made(2)) and pictures.complete_png(made(3)) == bool(interlaced) and not pictures.complete_png(made(2)[:-13])
