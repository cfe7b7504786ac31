"""HTML as elements: one linear pass over a page's tags, then selection by column expressions."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements without content, and those whose content is text up to their own end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style"))

_TAG = re.compile(r"""<(?:(!--|[!?])|(/?)([A-Za-z][^\s/>]*)([^>"']*(?:"[^"]*"[^>"']*|'[^']*'[^>"']*)*))""")
_ATTRIBUTE = re.compile(r"""([^\s/>=][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}

_ELEMENT = "struct<pos:int,last:int,tag:string,classes:array<string>,attributes:map<string,string>>"
_ARROW = pa.list_(
    pa.struct([
        ("pos", pa.int32()), ("last", pa.int32()), ("tag", pa.string()), ("classes", pa.list_(pa.string())), ("attributes", pa.map_(pa.string(), pa.string())),
    ])
)


def attributes_of(said: str) -> dict[str, str]:
    """A tag's attributes by lower-case name, character references decoded; of several with one name the last, of one without a value the empty text."""
    found = {}
    for m in _ATTRIBUTE.finditer(said):
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        found[m[1].lower()] = entities.unescape(value) if "&" in value else value
    return found


def elements_of(page: str | None, tags: Iterable[str], attributes: Iterable[str]) -> list[dict]:
    """The elements with one of some tags, in order: their place among all elements, that of the last element within them, their classes and some attributes.

    An end tag closes the innermost open element of its name and all within it,
    or nothing; what is open at the end of the page ends there. Comments,
    declarations and the content of scripts and styles hold no elements. A tag
    that the page breaks off is text.
    """
    page, tags, attributes = page or "", frozenset(tags), tuple(attributes)
    out: list[dict] = []
    open_now: list[tuple[str, dict | None]] = []
    depth: dict[str, int] = {}
    at, n = 0, 0
    while (m := _TAG.search(page, at)) is not None:
        at = m.end()
        if m[1]:
            end = page.find("-->", at) + 2 if m[1] == "!--" else page.find(">", at)
            if end < (2 if m[1] == "!--" else 0):
                break
            at = end + 1
            continue
        said = m[4]
        if page[at : at + 1] != ">":  # a quote without its second half is a sign like others
            end = page.find(">", at)
            if end < 0:
                break
            said += page[at:end]
            at = end
        at += 1
        name = m[3].lower()
        if m[2]:
            if depth.get(name):
                while True:
                    closed, element = open_now.pop()
                    depth[closed] -= 1
                    if element is not None:
                        element["last"] = n - 1
                    if closed == name:
                        break
            continue
        element = None
        if name in tags:
            found = attributes_of(said)
            element = {"pos": n, "last": n, "tag": name, "classes": found.get("class", "").split(), "attributes": [(k, found[k]) for k in attributes if k in found]}
            out.append(element)
        n += 1
        if name in VOID or said.endswith("/"):
            continue
        if name in RAW:
            if (end := _RAW_END[name].search(page, at)) is None:
                break
            at = end.start()
        open_now.append((name, element))
        depth[name] = depth.get(name, 0) + 1
    for _, element in open_now:
        if element is not None:
            element["last"] = n - 1
    return out


def elements(page: Column | str, tags: Iterable[str], attributes: Iterable[str]) -> Column:
    """``elements_of`` a column of pages, as an array; null and empty pages have none."""
    tags, attributes = tuple(tags), tuple(attributes)

    @F.arrow_udf(f"array<{_ELEMENT}>")
    def kernel(pages: pa.Array) -> pa.Array:
        return pa.array([elements_of(p.as_py(), tags, attributes) for p in pages], _ARROW)

    return kernel(page)


def tagged(found: Column, tag: str, named: str | None = None) -> Column:
    """Those of some elements that have a tag, and a class."""
    return F.filter(found, lambda e: (e["tag"] == tag) & F.array_contains(e["classes"], named) if named else e["tag"] == tag)


def within(found: Column, outer: Column) -> Column:
    """Those of some elements that lie in another; none in null."""
    return F.filter(found, lambda e: (e["pos"] > outer["pos"]) & (e["pos"] <= outer["last"]))


def value(element: Column, name: str) -> Column:
    """An attribute's value; null without it."""
    return F.try_element_at(element["attributes"], F.lit(name))
