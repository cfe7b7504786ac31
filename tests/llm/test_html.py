import html
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from sluice.llm import html_extract

DATA = "/root/testdata/sf0.001"


def page(body, side=""):
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head><body>"
        f"<nav><ul><li><a href='/'>Home</a></ul></nav><div class='cookie-notice'>We use cookies</div>{side}{body}<footer>(c)</footer></body></html>"
    )


def test_html(spark):
    article = "<article><h1>Head &amp; {0}</h1><p>One <b>bold</b>\n text{0}.<p>Two&nbsp;&lt;3<br>more<aside>see also</aside><form>mail</form><section id='comments'><p>First!</p></section></article>"
    rows = [(i, f"https://user@Site.org:80/{i}", page(article.format(i), "<div class=ad>Buy</div>")) for i in range(5)]
    plain = "<div class='box9'><div class='text'><p>Para {0} {0}</p><p>More {0}</p></div><div class='foot0'>always this</div></div>"
    rows += [(10 + i, f"http://other.net/{i}", page(plain.format(f"x{i} " * 30))) for i in range(4)]
    rows += [(20, None, None), (21, "x", ""), (22, "http://one.org/", "<p>alone &amp"), (0, rows[0][1], rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("host", F.lit(1))
    found = html_extract.extract(df).collect()
    got = {r["page_id"]: r for r in found}
    assert len(found) == len(rows)
    assert got[3]["text"] == "Head & 3\n\nOne bold text3.\n\nTwo <3 more"
    assert got[12]["text"] == f"Para {'x2 ' * 30}".strip() + " " + ("x2 " * 30).strip() + "\n\n" + f"More {('x2 ' * 30).strip()}"
    assert got[20]["text"] == got[21]["text"] == "" and got[22]["text"] == "alone &" and got[22]["n_chars"] == 7
    assert html_extract.extract(df.limit(0)).count() == 0


class Plain(HTMLParser):
    """What a well-marked page says, read by another parser: the blocks within its article but for what is left out by name."""

    def __init__(self):
        super().__init__()
        self.inside, self.out, self.blocks, self.said = 0, 0, [], []

    def cut(self):
        if text := " ".join("".join(self.said).split()):
            self.blocks.append(text)
        self.said = []

    def handle_starttag(self, tag, attrs):
        if tag in html_extract.BLOCKS:
            self.cut()
        self.inside += tag == "article"
        self.out += tag in ("nav", "aside", "form", "footer")
        if tag in html_extract.SPACES:
            self.said.append(" ")

    def handle_endtag(self, tag):
        if tag in html_extract.BLOCKS:
            self.cut()
        self.inside -= tag == "article"
        self.out -= tag in ("nav", "aside", "form", "footer")

    def handle_data(self, data):
        if self.inside and not self.out:
            self.said.append(data)


def test_html_of_all_pages_is_what_another_parser_reads(spark):
    df = spark.read.parquet(f"{DATA}/pages.parquet")
    expected = {}
    for r in df.collect():
        plain = Plain()
        plain.feed(r["html"])
        plain.close()
        plain.cut()
        expected[r["page_id"]] = "\n\n".join(plain.blocks)
    found = html_extract.extract(df).collect()
    assert {r["page_id"]: r["text"] for r in found} == expected and all(r["n_chars"] == len(r["text"]) for r in found)
    assert all(expected.values())


def test_the_template_finds_an_article_without_any_mark(spark, monkeypatch):
    """Two layouts on one host, elements without names that tell anything, text on all sides that only the other pages show to be none of the article."""

    def first(k):
        said = f"Own words of {k}. " * 20
        return f"<body><div class=k1><div>Home</div><div>About us and all that we do for you</div></div><div class=k2><div class=q7><p>{said}</p><div class=u>Tell your friends</div><p>End {k}.</p></div></div><div class=k3>All rights reserved {'by us ' * 9}</div>"

    def second(k):
        said = f"Other words of {k}. " * 20
        return f"<body><div class=m1>Shop<div class=m2>Cart {k}</div></div><div class=m3><div class=m4><p>{said}</p></div><div class=m5>Also at our place: {'things ' * 9}</div></div>"

    rows = [(k, f"http://two.org/{k}", first(k) if k % 2 else second(k)) for k in range(12)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert got[3] == ("Own words of 3. " * 20).strip() + "\n\nEnd 3." and got[4] == ("Other words of 4. " * 20).strip()
    # a class needs its size, and without classes nothing tells the article from what surrounds it
    monkeypatch.setattr(html_extract, "SIZE", 100)
    without = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert "All rights reserved" in without[3] and "Tell your friends" in without[3] and "Shop" in without[4]
    monkeypatch.undo()
    for most in (html_extract.BROADCAST_SLOTS, 0):  # broadcast, and joined in parts
        monkeypatch.setattr(html_extract, "BROADCAST_SLOTS", most)
        assert {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()} == got


def test_copies_of_a_page_keep_their_text(spark):
    body = "<body><div class=a><p>One text.</p></div><div class=b><div class=body>" + "<p>The same article. </p>" * 9 + "</div><p>Seen {0}</p></div>"
    df = spark.createDataFrame([(k, f"http://c.org/{k}", body.format(k)) for k in range(5)], "page_id long, url string, html string")
    assert all("The same article." in r["text"] for r in html_extract.extract(df).collect())


@pytest.mark.parametrize(
    "part", ["<div class='story-share-price'>k</div>", "<p class='related'>k</p>", "<section class='discussion'>k</section>", "<p class='alert'>k</p>", "<div class='research notice-board'>k</div>", "<label>k</label>", "<fieldset>k</fieldset>", "<a title=Joe's>k</a>"]
)
def test_names_that_only_sound_like_furniture_stay(part):
    assert html_extract.article(f"<article><p>one</p>{part}<p>two</article>", [], []) == "one\n\nk\n\ntwo"


@pytest.mark.parametrize("part", ["<div class='cookie-notice'>k</div>", "<div class='shareButtons top'>k</div>", "<section id=comments>k</section>", "<form>k</form>", "<aside>k</aside>", "<div hidden>k</div>", "<script>k</script>", "<!-- k -->", "<ul role=menu><li>k</ul>"])
def test_furniture_goes(part):
    assert html_extract.article(f"<article><p>one</p>{part}<p>two</article>", [], []) == "one\n\ntwo"


@pytest.mark.parametrize("name", "header site-header site-footer page-footer navbar-collapse topnav ad-unit google-ads related-posts disqus_thread comment-body comment-text user-comments cookie-policy right-col-sidebar commentThread".split())
def test_furniture_goes_by_its_head_word(name):
    assert html_extract.article(f"<div><p>one</p><div class='x {name}'><p>k</p></div><p>two</div>", [], []) == "one\n\ntwo"
    if not name.endswith("header"):  # within an article a header is the article's
        assert html_extract.article(f"<article><p>one</p><section id={name}>k</section><p>two</article>", [], []) == "one\n\ntwo"


@pytest.mark.parametrize("part", ["<article class=comment>k</article>", "<article id='c7' class='user-comment even'>k</article>", "<article class=comment-body><p>k</article>"])
def test_what_readers_wrote_goes_from_marked_elements(part):
    assert html_extract.article(f"<article><p>one</p>{part}<p>two</article>", [], []) == "one\n\ntwo"
    assert html_extract.article(f"<main><article class=post><p>one</p></article>{part}</main>", [], []) == "one"


@pytest.mark.parametrize("part", ["<div class='social content'>k</div>", "<section id=responses>k</section>", "<div class=cookie-recipe>k</div>", "<div class=ad-hoc>k</div>", "<div class=entry-header>k</div>", "<article class='commentary'>k</article>", "<div class=more-about>k</div>", "<div class=header>k</div>"])
def test_content_that_sounds_like_furniture_stays(part):
    assert html_extract.article(f"<article><p>one</p>{part}<p>two</article>", [], []) == "one\n\nk\n\ntwo"


def test_references_and_white_space():
    said = "a &amp; b&nbsp;&#8364; &eacute;&lt;p&gt; 3 < 5 <3"
    assert html_extract.article(f"<article>{said}\n\t x</article>", [], []) == " ".join(html.unescape(said).split()) + " x"


def test_any_page_takes_time_in_proportion_to_its_length():
    kinds = ["<a ", '<p title="', "<div>", "</x></div>", "<", "<!--", "<script>", "<p a='", "<p a = ", "<p>x", "<div class=a>x", "</p>", "<table><tr><td>", "<li><ul>"]
    for part in kinds:
        text = part * (1_000_000 // len(part)) if part != "<div>" else "<div>" * 100_000 + "deep" + "</div>" * 100_000
        start = time.process_time()
        page = html_extract.read(text)
        html_extract.tokens_of(page)
        html_extract.article(text, [], [])
        assert time.process_time() - start < 20, part
