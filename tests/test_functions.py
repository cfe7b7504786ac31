import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.functions import arrays, markup, pixels
from sluice.functions import text as T
from sluice.sources import web


def value(spark, column, **cells):
    rows = [tuple(cells.values())] if cells else [(0,)]
    return spark.createDataFrame(rows, list(cells) or ["x"]).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "column, expected",
    [
        (lambda: T.keyword_dir(F.lit(' a<b>:"c d|?* ')), "abc_d"),
        (lambda: T.url_extension(F.lit("http://x/a.JPG?w=1")), ".jpg"),
        (lambda: T.url_extension(F.lit("http://x/a.jpg#t")), None),
        (lambda: T.mime_extension(F.lit("IMAGE/PNG")), ".png"),
        (lambda: T.mime_extension(F.lit("image/jpeg; charset=x")), None),
        (lambda: T.source_of_url(F.lit("https://live.StaticFlickr.com/a")), "flickr"),
        (lambda: T.source_of_url(F.lit("https://upload.wikipedia.org")), "wikimedia"),
        (lambda: T.source_of_url(F.lit("https://x.org")), "unknown"),
        (lambda: T.large_variant(F.lit("a_th.b_th.jpg")), "a_lrg.b_lrg.jpg"),
        (lambda: T.large_variant(F.lit("a_med.x_small.jpg")), "a_lrg.x_small.jpg"),
        (lambda: T.absolute_url(F.lit("/a"), "https://b"), "https://b/a"),
        (lambda: T.absolute_url(F.lit("http://a"), "https://b"), "http://a"),
        (lambda: T.photo_url(F.lit("1"), F.lit("2"), F.lit("3")), "https://live.staticflickr.com/1/2_3_b.jpg"),
        (lambda: T.photo_url(F.lit(""), F.lit("2"), F.lit("3")), None),
        (lambda: T.first_filled(F.lit(""), F.lit("b")), "b"),
        (lambda: T.video_url(F.lit(""), F.lit("x1"), "https://v/"), "https://v/x1"),
        (lambda: T.truncated(F.lit(""), 5), None),
        (lambda: T.truncated(F.lit("abcdef"), 5), "abcde"),
        (lambda: T.output_name(F.lit("/r/dir/x.png")), "dir_x.png"),
        (lambda: T.numbered_name(F.lit("v"), F.lit(7), ".png"), "v_00007.png"),
        (lambda: T.keyword_list(F.lit(" a,, b\t,")), ["a", "b"]),
        (lambda: T.prompt_lines(F.lit("a\r\n\n b \rc")), ["a", "b", "c"]),
        (lambda: T.search_url("bing", F.lit("a b/c")), "https://www.bing.com/images/search?q=a%20b/c&count=150"),
        (lambda: T.blocked_as_bot(F.lit("please solve the captcha")), True),
        (lambda: T.is_image(F.lit("/a/b.JPeG")), True),
        (lambda: T.is_image(F.lit("/a.jpg/b")), False),
        (lambda: T.is_video(F.lit("x.MKV")), True),
    ],
)
def test_text(spark, column, expected):
    assert value(spark, column()) == expected


def test_sign_hash_sets_the_first_bit_highest(spark):
    vector = [1.0] + [0.0] * 63
    assert value(spark, arrays.sign_hash("v"), v=vector) == -(1 << 63)
    assert value(spark, arrays.hamming(F.lit(-1), F.lit(0))) == 64


def test_correlation_of_constants_is_one(spark):
    assert value(spark, arrays.correlation("a", "b"), a=[1.0, 1.0], b=[0.0, 3.0]) == 1.0
    assert value(spark, arrays.correlation("a", "b"), a=[1.0, 2.0, 4.0], b=[4.0, 2.0, 1.0]) == pytest.approx(np.corrcoef([1, 2, 4], [4, 2, 1])[0, 1])


def test_laplacian_matches_the_kernel(spark):
    picture = np.random.default_rng(0).random((8, 8))
    assert value(spark, arrays.laplacian_variance("v", 8), v=picture.ravel().tolist()) == pytest.approx(pixels.laplacian_variance(picture))


def test_softmax_and_percent(spark):
    assert value(spark, arrays.softmax("v"), v=[1000.0, 1000.0]) == [0.5, 0.5]
    assert value(spark, arrays.percent(F.lit(1), F.lit(0))) == 0.0
    assert value(spark, arrays.normalized("v"), v=[0.0, 0.0]) == [0.0, 0.0]


def test_pixels():
    flat = np.full((40, 40, 3), 90, np.uint8)
    assert pixels.laplacian_variance(pixels.gray(flat)) == 0
    assert pixels.edge_share(pixels.gray(flat)) == 0
    board = np.kron(np.indices((5, 5)).sum(0) % 2, np.ones((8, 8)))[..., None].repeat(3, 2).astype(np.uint8) * 255
    assert pixels.laplacian_variance(pixels.gray(board)) > 100
    assert pixels.edge_share(pixels.gray(board)) > 0.05
    blue = np.zeros((10, 10, 3), np.uint8)
    blue[:5, :, 0] = 200
    assert pixels.blue_share(blue) == 0.5
    picture = np.random.default_rng(1).integers(0, 256, (64, 64, 3)).astype(np.uint8)
    near = picture.copy()
    near[0, 0] = 128
    assert bin((pixels.perceptual_hash(picture) ^ pixels.perceptual_hash(near)) & (1 << 64) - 1).count("1") <= 4
    assert np.linalg.norm(pixels.histogram(board)[:256]) == pytest.approx(1)


PAGES = {
    '<div class="main-image"><div></div><img src="/a.jpg"></div>': "b/a.jpg",
    "<div class='main-image'><img src='/a.jpg'></div>": "b/a.jpg",
    "<DIV CLASS=main-image><IMG SRC=/a.jpg></DIV>": "b/a.jpg",
    '<div id=x class="x main-image y"><p><img src="" data-src="/a.jpg"></div>': "b/a.jpg",
    '<div class="main-images"><img src="/no.jpg"></div><article><b><img src="/a.jpg"></b></article>': "b/a.jpg",
    '<div class="main-image"></div><img src="/no.jpg"><div class="image-wrapper"><img src="/a_th.jpg">': "b/a_lrg.jpg",
    '<div class="content-wrapper"><img src="/no.jpg"></div><div class="content"><img src="/icon.jpg"><img src="/a.jpg"></div>': "b/a.jpg",
    '<meta content="http://og?a&amp;b" property="og:image">': "http://og?a&b",
    '<!-- <div class="content"><img src="/no.jpg"></div> --><style>a{}<img src="/no.jpg"></style><article></article>': None,
    '<div class="content"></div><img src="/no.jpg">': None,
    '<article title="a > b \' c"><img title=\'"\' src=/a.jpg></article>': "b/a.jpg",
    "<article><img src='/a.jpg>": "b'/a.jpg",
    "": None,
}


def test_main_images_as_a_parser_reads_them(spark):
    pages = spark.createDataFrame([*enumerate(PAGES), (99, None)], "page_id int, html string")
    found = {r["page_id"]: r["url"] for r in web.main_image(pages, "b").collect()}
    assert [found[k] for k in range(len(PAGES))] == list(PAGES.values()) and found[99] is None


def test_links_as_a_parser_reads_them(spark):
    pages = [
        """<a href='/x'>1</a><a href=/y>2</a><A HREF="/z">3</A><a href="/a?b=1&amp;c=2">4</a><abbr href="/no"></abbr><a data-href="/no" href = "/x">5</a><a>6</a>""",
        '<article><h2>t</h2><p><a href="/deep">1</a><a href="/no">2</a></p></article><a href="/no">3</a><article></article><article><a href="">4</a></article>',
        '<article><a href="/no"></a></article><a class="x card-image" href="/card"></a><a class="card-images" href="/no"></a>',
    ]
    pages = spark.createDataFrame([*enumerate(pages), (9, None)], "page_id int, html string")
    urls = lambda found, k: [r["url"] for r in found.where(f"page_id = {k}").orderBy("pos").collect()]
    assert urls(web.links(pages, "b"), 0) == ["b/x", "b/y", "b/z", "b/a?b=1&c=2"]
    assert urls(web.article_links(pages, "b"), 1) == ["b/deep"] and urls(web.article_links(pages, "b"), 2) == ["b/card"]
    assert urls(web.links(pages, "b"), 9) == [] and web.thumbnails(pages, "b").count() == 0


def test_elements_take_linear_time():
    found = lambda page: markup.elements_of(page, ["a", "div"], ["href"])
    start = time.perf_counter()
    n = 100_000
    for page in ("<div>" * n, "</p>" * n, "<div></p>" * n, '<a "' * n, "<a '" * n + '"', "<!--" * n, "<a <" * n, "<script>" * n, "<a" + " " * n + ">", "<a x" + "=" * n + ">", "<" * n, '<div><a b="' * n, "<a href=\"'>" * n):
        found(page)
    assert time.perf_counter() - start < 20
    deep = found("<div>" * 1000 + "</div>" * 999 + "<a href=x>")
    assert [(e["pos"], e["last"]) for e in deep[:2]] == [(0, 1000), (1, 999)] and deep[-1]["attributes"] == [("href", "x")]
