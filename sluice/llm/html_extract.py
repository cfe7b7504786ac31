"""Main text of web pages by equivalence-class template deduction.

A token is the opening of an element, told apart by its place: the labels of
the elements around it. A page counts the tokens that it has once, inside
elements that it has once. Tokens of a host with the same occurrence vector,
that is on the same of the host's pages, form an equivalence class. A class is
valid if it has SIZE tokens or more and is on MIN_PAGES pages or more; being
places in a tree, its tokens nest, and so do the classes: together they are the
host's template, which has a class of its own for each layout of the host.
Between the tokens of the classes that a page has lie its slots.

The article's slot is the deepest template element that holds most of the text
on the pages of its class and doesn't say the same on all of them; elements
that are marked as an article or main part come first. Template elements inside
it that say the same on all their pages are no part of the article, unless they
make up most of it: then the pages are copies. Names, roles and classes decide
what the template can't tell apart: menus, headers, footers, sidebars, notices,
adverts, forms and comments within a slot, and pages without a template.

Occurrence vectors are never gathered: a vector is known by the exclusive or of
hashes of its pages, which is combined before the shuffle.
"""

from __future__ import annotations

import html as entities
import re
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import Kernel, map_slices, texts_of
from sluice.session import checkpointed

#: Pages and tokens a class needs, the share of the text that the deepest fitting slot holds of the largest one's.
MIN_PAGES, SIZE, MOST_TEXT = 3, 3, 0.6
#: Slots of all host templates sent to every task; more are joined, each host in SALTS parts.
BROADCAST_SLOTS, SALTS = 200_000, 32

#: Names of elements, roles and words of classes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul".split()
)
SPACES = frozenset("br td th option wbr img".split())
LEFT_OUT = frozenset("aside audio button canvas datalist dialog footer form head menu nav object search select svg template video".split())
UNREAD = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
WORDS = frozenset(
    "ad ads adbox adslot advert advertisement adverts banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus footer gdpr login menu modal nav navbar navigation newsletter notice notices overlay pagination paywall popup promo "
    "promoted recommended respond share sharing sidebar signup skip social sponsor sponsored subscribe toolbar topbar widget widgets".split()
)
FILLING = frozenset("area bar block bottom box button buttons container content form inner item items left links list main outer right section top wrap wrapper".split())
#: Words that say what an element is where they come last; where they, or those after them, come first, followed by words for a part of it; a header's first words.
LAST = frozenset("ads adverts advertisement breadcrumb breadcrumbs comment comments footer nav navbar navigation pagination sidebar topnav".split())
FIRST = LAST | frozenset("ad advert cookie cookies disqus gdpr newsletter".split())
PARTS = FILLING | frozenset("author body code collapse count entry feed header id label meta placement policy post reply settings slot text thread title toggle unit zone".split())
SITE = FILLING | frozenset("blog global masthead page site web".split())
#: What others wrote, and lists of other pages.
TALK = frozenset("comment comments disqus".split())
OTHERS, PAGES = frozenset("latest more popular recommended related similar trending".split()), frozenset("articles links news posts reading stories topics".split())
#: Words that mean nothing beside a class that names the content.
WEAK = frozenset("recommended share sharing skip social".split())
PARAGRAPHS = frozenset("blockquote dd dt figcaption h1 h2 h3 h4 h5 h6 li p pre tr td th".split())
MARKED = frozenset("article main".split())
MARKED_WORDS = frozenset("article content entry main post story".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]*)))?")
_GAP = re.compile(r"[\s/=]*")
_CLOSING = {name: re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE) for name in UNREAD}
_NUMBER, _LONG_NUMBER = re.compile(r"\d+"), re.compile(r"\d{3,}")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_PRIME, _BASE = (1 << 61) - 1, 0x1F3A9C5D7


def markup(page: str):
    """(text before, name, whether it ends an element, attributes) of every tag, in one pass; the last has no name.

    As browsers do it: quotes count only around a value, a tag that is never
    closed takes the rest with it, so does a script or a comment.
    """
    at = start = 0
    while (at := page.find("<", at)) >= 0:
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            yield page[start:at], "!", False, {}
            start = at = end + 3 if end >= 0 else len(page)
            continue
        following = page[at + 1 : at + 2]
        closes = following == "/"
        name = _NAME.match(page, at + 1 + closes)
        if name is None:
            if following and following in "!?/":
                end = page.find(">", at)
                yield page[start:at], "!", False, {}
                start = at = end + 1 if end >= 0 else len(page)
            else:
                at += 1
            continue
        before, attributes, place = page[start:at], {}, name.end()
        while (place := _GAP.match(page, place).end()) < len(page) and page[place] != ">":
            found = _ATTRIBUTE.match(page, place)
            key = found[1].lower()
            if key not in attributes:
                attributes[key] = found[2] or found[3] or found[4] or ""
            place = found.end()
        start = at = place + 1
        called = name[0].lower()
        yield before, called, closes, attributes
        if called in UNREAD and not closes:
            end = _CLOSING[called].search(page, at)
            start = at = end.start() if end else len(page)
    yield page[start:], "", False, {}


def named_out(classes: str, own: bool = False, marked: bool = False) -> bool:
    """Whether some class names what is left out.

    It does if it has such words and none that say otherwise; if its last word
    is one for the thing itself, as in site-footer; if its first is and the
    others are for parts, as in comment-body; and if it names other pages. A
    header is a site's unless it is within a marked element. An element that is
    itself marked is left out only as what others wrote.
    """
    every = [[w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", one).lower()) if w] for one in classes.split()]
    content = any(len(words) == 1 and words[0] in MARKED_WORDS for words in every)
    for words in every:
        if not words:
            continue
        first, last, rest = words[0], words[-1], words[1:]
        if own:
            if last in TALK or first in TALK and all(w in PARTS for w in rest):
                return True
            continue
        if any(w in WORDS for w in words) and all(w in WORDS or w in FILLING for w in words) and not (content and all(w in WEAK for w in words)):
            return True
        if last in LAST or first in FIRST and all(w in PARTS or w in WORDS for w in rest) or first in OTHERS and last in PAGES:
            return True
        if last == "header" and not marked and all(w in SITE for w in words[:-1]):
            return True
    return False


@dataclass(slots=True)
class Element:
    """An element with its place, and the blocks inside, from first up to last."""

    name: str
    path: int
    out: bool
    marked: bool
    rank: int
    classed: bool
    depth: int
    above: int
    first: int
    last: int = -1


@dataclass
class Page:
    """What a page says, block by block (text, left out, in a marked element), and its elements in the order in which they open."""

    blocks: list[tuple[str, bool, bool]] = field(default_factory=list)
    elements: list[Element] = field(default_factory=list)

    def once(self) -> dict[int, Element]:
        """The elements that have their place to themselves, as have those around them."""
        count: dict[int, int] = {}
        for e in self.elements:
            count[e.path] = count.get(e.path, 0) + 1
        alone: list[bool] = []
        for e in self.elements:
            alone.append(count[e.path] == 1 and (e.above < 0 or alone[e.above]))
        return {e.path: e for e, fine in zip(self.elements, alone) if fine and not (e.out and e.above >= 0 and self.elements[e.above].out)}


def _element(name: str, attributes: dict[str, str], above: Element | None, at: int, first: int) -> Element:
    named = " ".join(attributes[k] for k in ("class", "id") if k in attributes)
    # numbers of an id and long ones of a class tell pages apart, not places
    label = f"{name}.{' '.join(_LONG_NUMBER.sub('0', attributes.get('class', '')).split())}#{_NUMBER.sub('0', attributes.get('id', ''))}".lower()
    role = attributes.get("role", "").lower()
    own = name in MARKED or role in ("main", "article")
    out = above is not None and above.out or (
        name in LEFT_OUT
        or name == "header" and not (above and above.marked)
        or role in ROLES
        or "hidden" in attributes
        or attributes.get("aria-hidden", "").lower() == "true"
        or bool(_HIDDEN.search(attributes.get("style", "").lower()))
        or bool(named) and name not in PARAGRAPHS and name not in ("body", "html") and named_out(named, own, bool(above and above.marked))
    )
    rank = 2 if own else int(bool(named) and not MARKED_WORDS.isdisjoint(re.split("[^a-z]+", named.lower())))
    path = xxhash.xxh3_64_intdigest(label.encode("utf-8", "surrogatepass"), seed=above.path if above else 0)
    return Element(name, path, out, own or bool(above and above.marked), rank, bool(named.strip()), above.depth + 1 if above else 0, at, first)


def read(page: str) -> Page:
    """One pass over a page; time and memory grow with its length, however it is nested."""
    out = Page()
    stack: list[int] = []
    open_names: dict[str, int] = {}
    text: list[str] = []

    def flush() -> None:
        joined = " ".join("".join(text).split())
        text.clear()
        if joined:
            top = out.elements[stack[-1]] if stack else None
            out.blocks.append((joined, bool(top and top.out), bool(top and top.marked)))

    def close() -> None:
        e = out.elements[stack.pop()]
        e.last = len(out.blocks)
        open_names[e.name] -= 1

    for before, name, closes, attributes in markup(page):
        if before:
            text.append(entities.unescape(before))
        if name in SPACES:
            text.append(" ")
        if name and name not in BLOCKS and name not in LEFT_OUT:
            continue
        flush()
        if not name:
            break
        if closes:
            if open_names.get(name):
                while out.elements[stack[-1]].name != name:
                    close()
                close()
            continue
        if name in VOID:
            continue
        # a paragraph ends where a block begins, an item where its next one does
        if stack and out.elements[stack[-1]].name == "p" and name in BLOCKS:
            close()
        if stack and name in ("li", "dd", "dt", "tr") and out.elements[stack[-1]].name in (("dd", "dt") if name[0] == "d" else (name,)):
            close()
        above = stack[-1] if stack else -1
        out.elements.append(_element(name, attributes, out.elements[above] if stack else None, above, len(out.blocks)))
        stack.append(len(out.elements) - 1)
        open_names[name] = open_names.get(name, 0) + 1
    while stack:
        close()
    return out


def _signed(n: int) -> int:
    return n - (1 << 64) if n >= 1 << 63 else n


def tokens_of(page: Page) -> list[tuple[int, int, int, int, int, int, bool, int]]:
    """(path, chars, total, said, rank, depth, classed, blocks) of every token of a page. ``said`` tells texts apart, and is
    taken from sums over the blocks so far, so nested elements cost no more than others."""
    chars, said, power = [0], [0], [1]
    for text, out, _ in page.blocks:
        chars.append(chars[-1] + (0 if out else len(text)))
        said.append((said[-1] * _BASE + xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)
    rows = []
    for path, e in page.once().items():
        value = (said[e.last] - said[e.first] * power[e.last - e.first]) % _PRIME
        rows.append((_signed(path), 0 if e.out else chars[e.last] - chars[e.first], chars[-1], value, e.rank, e.depth, e.classed, e.last - e.first))
    return rows


def _host(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def templates(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(host, slots, same): of each host with a template, its elements that may be the article's, and those that say the same on all their pages."""
    names = ("path", "chars", "total", "said", "rank", "depth", "classed", "blocks")

    def make() -> Kernel:
        def kernel(batch: pa.RecordBatch) -> dict:
            rows = [(k, *token) for k, page in enumerate(texts_of(batch, html_column)) for token in tokens_of(read(page))]
            columns = list(zip(*rows)) or [()] * (len(names) + 1)
            at = pa.array(columns[0], pa.int64())
            return {"host": batch.column("host").take(at), "page": batch.column("page").take(at)} | dict(zip(names, columns[1:]))

        return kernel

    source = pages.select(_host(url_column).alias("host"), F.xxhash64(id_column, url_column, html_column).alias("page"), html_column)
    tokens = map_slices(source, make, "host string, page bigint, path bigint, chars bigint, total bigint, said bigint, rank int, depth bigint, classed boolean, blocks bigint")
    found = (
        tokens.groupBy("host", "path")
        .agg(
            F.bit_xor("page").alias("vector"),
            F.count(F.lit(1)).alias("on"),
            F.sum("chars").alias("chars"),
            F.sum("total").alias("total"),
            (F.min("said") == F.max("said")).alias("same"),
            F.max("rank").alias("rank"),
            F.max("depth").alias("depth"),
            F.max("classed").alias("classed"),
            F.sum("blocks").alias("blocks"),
        )
        .where(F.col("on") >= MIN_PAGES)
    )
    # the tokens of one vector are a class; of those with about the same share of the text the deepest is enough
    share = F.when(F.col("same"), 0.0).otherwise(F.col("chars") / F.col("total"))
    parts = found.withColumn("share", F.coalesce(share, F.lit(0.0))).groupBy("host", "vector", "on", "rank", F.floor(F.col("share") * 20).alias("twentieths")).agg(
        F.count(F.lit(1)).alias("size"),
        F.max(F.when(F.col("share") > 0, F.struct("depth", "share", "path"))).alias("slot"),
        F.collect_list(F.when(F.col("same") & F.col("classed") & (F.col("blocks") > 0), F.col("path"))).alias("same"),
    )
    classes = parts.groupBy("host", "vector", "on").agg(
        F.sum("size").alias("size"),
        F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("rank", "slot.share", "slot.depth", "slot.path"))).alias("slots"),
        F.flatten(F.collect_list("same")).alias("same"),
    )
    return (
        classes.where(F.col("size") >= SIZE)
        .groupBy("host")
        .agg(F.flatten(F.collect_list("slots")).alias("slots"), F.flatten(F.collect_list("same")).alias("same"))
        .where(F.size("slots") > 0)
    )


def article(html: str, slots: list[dict], same: list[int]) -> str:
    """The main text of a page: from its host's slots that it has, or by marks and names alone."""
    page = read(html)
    blocks = page.blocks
    first, last, gone = 0, len(blocks), []
    if slots:
        mine = {_signed(path): e for path, e in page.once().items()}
        able = [(s["rank"], s["share"], s["depth"], s["path"]) for s in slots if s["path"] in mine]
        if able:
            best = max(s[0] for s in able)
            able = [s for s in able if s[0] == best]
            most = max(s[1] for s in able)
            chosen = mine[max((s[2], s[1], s[3]) for s in able if s[1] >= MOST_TEXT * most)[2]]
            first, last = chosen.first, chosen.last
            inner = [mine[p] for p in same if p in mine and mine[p] is not chosen]
            gone = [(e.first, e.last) for e in inner if first <= e.first and e.last <= last and (e.first, e.last) != (first, last)]
    kept = [k for k in range(first, last) if not blocks[k][1]]
    if any(blocks[k][2] for k in kept):
        kept = [k for k in kept if blocks[k][2]]
    drop = {k for a, b in gone for k in range(a, b)} if gone else set()
    rest = [k for k in kept if k not in drop]
    if 2 * sum(len(blocks[k][0]) for k in rest) > sum(len(blocks[k][0]) for k in kept):
        kept = rest
    return "\n\n".join(blocks[k][0] for k in kept)


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page.

    Null and empty pages have an empty text; pages without a host form one host;
    repeated rows give repeated rows, and a pair of them adds nothing to an
    occurrence vector but counts as two pages; an empty table gives an empty
    result; other columns are not read.
    """
    found = checkpointed(templates(pages, id_column, url_column, html_column))
    rows = pages.select(F.col(id_column).alias("_id"), F.col(url_column).alias("_url"), F.col(html_column).alias("_html"), _host(url_column).alias("host"))
    size = found.agg(F.sum(F.size("slots") + F.size("same"))).first()[0] or 0
    if size <= BROADCAST_SLOTS:
        joined = rows.join(F.broadcast(found), "host", "left")
    else:
        parts = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int")).join(parts, ["host", "salt"], "left")

    def make() -> Kernel:
        def kernel(batch: pa.RecordBatch) -> dict:
            slots, same = batch.column("slots").to_pylist(), batch.column("same").to_pylist()
            texts = [article(p, s or [], c or []) for p, s, c in zip(texts_of(batch, "_html"), slots, same)]
            return {id_column: batch.column("_id"), url_column: batch.column("_url"), "text": texts, "n_chars": [len(t) for t in texts]}

        return kernel

    kinds = dict(pages.dtypes)
    ddl = f"{id_column} {kinds[id_column]}, {url_column} string, text string, n_chars bigint"
    return map_slices(joined.select("_id", "_url", "_html", "slots", "same"), make, ddl)
