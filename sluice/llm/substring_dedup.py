"""Substring dedup on sliding sentence spans.

A text is cut into sentences (at line ends, and after . ! ? … with any closing
quotes before white space); a sentence of more than 2 * AROUND words counts as
several, so that no passage is a single one: it is cut before every word whose
hash is the least among AROUND words on both sides, so equal passages are cut
alike wherever they stand. Where no word is for LONG words, as in periodic
text, a cut comes after LONG words. From each sentence on, and back from each sentence, the
shortest run of at least RUN sentences and WORDS words is a span. Spans are
hashed and joined globally; every occurrence of a span after the first, in
order of document and place, is repeated, and the sentences it covers are
taken out.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import Kernel, map_slices, texts_of
from sluice.session import checkpointed

RUN, WORDS, LONG, AROUND = 2, 20, 24, 3
#: Spans with more occurrences than this are joined in SALTS parts.
HOT, SALTS = 10_000, 64
BROADCAST_HASHES = 100_000

_END = re.compile(r"[.!?…][\"'”’)\]]*(?=\s|$)|\n")
_WORD = re.compile(r"\S+")


def cut(text: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words of a text, their hashes, and where each sentence or piece of one begins among them."""
    words: list[str] = []
    starts, at = [], 0
    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        own = text[at:end].split()
        at = end
        if own:
            starts.append(len(words))
            words += own
    n, side = len(words), AROUND
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    places = first = np.array(starts, np.int64)
    if n > 2 * side:
        sizes = np.diff(first, append=n)
        inside = np.arange(n) - np.repeat(first, sizes)
        fine = (inside >= side) & (np.repeat(sizes, sizes) - inside > side)
        least = fine[side : n - side]
        own_hash = hashes[side : n - side]
        for k in range(1, side + 1):
            least &= own_hash < hashes[side - k : n - side - k]
            least &= own_hash <= hashes[side + k : n - side + k]
        fine[first] = True
        places = np.flatnonzero(fine)
    sizes = np.diff(places, append=n)
    if (sizes > LONG).any():
        parts = -(-sizes // LONG)
        ends = np.cumsum(parts)
        places = np.repeat(places, parts) + LONG * (np.arange(ends[-1]) - np.repeat(ends - parts, parts))
    return words, hashes, places


def sentences(text: str) -> list[list[str]]:
    """The words of every sentence or piece of one."""
    words, _, places = cut(text)
    at = places.tolist()
    return [words[a:b] for a, b in zip(at, [*at[1:], len(words)])]


def stretches_of(text: str, units: list[list[str]], gone: list[bool]) -> list[tuple[int, int]]:
    """(start, end) in code points of every run of sentences that go, without white space around."""
    out: list[tuple[int, int]] = []
    words = _WORD.finditer(text)
    joined = False
    for unit, away in zip(units, gone):
        own = [next(words) for _ in unit]
        if away:
            out.append((out.pop()[0] if joined else own[0].start(), own[-1].end()))
        joined = away
    return out


def spans_of(total: np.ndarray, run: int = RUN, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) of every span of sentences, each once, from the number of words before each sentence and all."""
    n = len(total) - 1
    at = np.arange(n)
    last = np.maximum(at + run - 1, np.searchsorted(total, total[:-1] + words) - 1)  # the shortest run from each on
    first = np.minimum(at - run + 1, np.searchsorted(total, total[1:] - words, "right") - 1)  # and back from each
    some, back = last < n, first >= 0
    both = np.unique(np.concatenate([at[some] << 32 | last[some], first[back] << 32 | at[back]]))
    return both >> 32, both & 0xFFFFFFFF


def spans(units: list[list[str]], run: int = RUN, words: int = WORDS) -> list[tuple[int, int]]:
    """(first, last) of every span of sentences, each once."""
    first, last = spans_of(np.cumsum([0, *map(len, units)]), run, words)
    return list(zip(first.tolist(), last.tolist()))


_POWERS = np.ones((2, 1), np.uint64)


def _powers(n: int) -> np.ndarray:
    """The first powers of an odd number and of its inverse among numbers of 64 bits."""
    global _POWERS
    if _POWERS.shape[1] < n:
        base = 0x9E3779B97F4A7C15
        steps = np.array([[base], [pow(base, -1, 1 << 64)]], np.uint64).repeat(2 * n, 1)
        steps[:, 0] = 1
        _POWERS = np.cumprod(steps, 1, dtype=np.uint64)
    return _POWERS


def hashes_of(hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits of each run of words, from start up to end, wherever it stands: a polynomial of their hashes, from sums over the words before."""
    up, down = _powers(len(hashes) + 1)[:, : len(hashes) + 1]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up[:-1], dtype=np.uint64)])
    value = (sums[end] - sums[start]) * down[start]
    value = (value ^ (value >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + (end - start).astype(np.uint64)
    return (value ^ (value >> np.uint64(32))).view(np.int64)


def span_hash(said: list[str], first: int, last: int) -> int:
    """64 bits of the words of a span, whatever the white space between them and wherever the span stands."""
    words = " ".join(said[first : last + 1]).split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return int(hashes_of(hashes, np.array([0]), np.array([len(words)]))[0])


def _told_apart(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, said, text): said tells apart the texts that share an id or have none; it is empty where every row has an id of its own."""
    shared = docs.groupBy(id_column).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col(id_column).isNull())
    said = F.md5(F.coalesce(F.col(text_column), F.lit(""))) if shared.limit(1).count() else F.lit("")
    return docs.select(F.col(id_column).alias("id"), said.alias("said"), F.col(text_column).alias("text"))


def _spans(texts: DataFrame, run: int, words: int) -> DataFrame:
    """(id, said, hash, place) of every span of every whole text; a place is first << 32 | last, one number to shuffle for two."""

    def make() -> Kernel:
        def kernel(batch: pa.RecordBatch) -> dict:
            none = np.empty(0, np.int64)
            sizes, hashes, places = [], [none], [none]
            for text in texts_of(batch):
                said, own, at = cut(text) if len(text) >= words else ((), none, none)
                if len(said) < words:
                    sizes.append(0)
                    continue
                total = np.append(at, len(said))
                first, last = spans_of(total, run, words)
                hashes.append(hashes_of(own, total[first], total[last + 1]))
                places.append(first << 32 | last)
                sizes.append(len(first))
            of = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            return {"id": batch.column("id").take(of), "said": batch.column("said").take(of), "hash": np.concatenate(hashes), "place": np.concatenate(places)}

        return kernel

    return map_slices(texts, make, f"id {dict(texts.dtypes)['id']}, said string, hash bigint, place bigint", 256)


def repeated_spans(texts: DataFrame, run: int = RUN, words: int = WORDS) -> DataFrame:
    """(id, said, repeated array<long>): of each text of (id, said, text) that has any, the places of the spans that occurred before.

    First is the occurrence with the smallest id, none before all, then the smallest place. The
    spans are derived twice, for the count and for the join, which is cheaper
    than to keep them: only hashes and places are shuffled. A hash with more
    than HOT occurrences is joined in SALTS parts; such hashes are at most one
    in HOT of all spans, and the list of them is broadcast if it has up to
    BROADCAST_HASHES entries (beyond that Spark's own skew handling is left to
    split them).
    """
    every = _spans(texts, run, words)
    repeats = every.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "said", "place")).alias("origin")).where("n > 1")
    repeats = checkpointed(repeats)
    hot = repeats.where(F.col("n") > HOT).select("hash")
    some = 0 < hot.limit(BROADCAST_HASHES + 1).count() <= BROADCAST_HASHES
    if some:
        every = every.join(F.broadcast(hot.select("hash", F.lit(True).alias("hot"))), "hash", "left")
        every = every.withColumn("salt", F.when(F.col("hot"), F.pmod(F.xxhash64("id", "said", "place"), F.lit(SALTS))).otherwise(0).cast("int"))
        width = F.when(F.col("n") > HOT, SALTS).otherwise(1)
        repeats = repeats.withColumn("salt", F.explode(F.sequence(F.lit(0), width - 1)))
    later = every.join(repeats, ["hash", "salt"] if some else ["hash"]).where(
        ~(F.col("id").eqNullSafe(F.col("origin.id")) & (F.col("said") == F.col("origin.said")) & (F.col("place") == F.col("origin.place")))
    )
    return later.groupBy("id", "said").agg(F.collect_set("place").alias("repeated"))


def without(text: str, covered: list[tuple[int, int]]) -> str:
    """The text without some stretches of it and without the white space that was between them and what follows."""
    out, at = "", 0
    for start, end in covered:
        out += text[at:start]
        at = end
        while at < len(text) and text[at].isspace() and (not out or out[-1].isspace()):
            at += 1
    return (out + text[at:]).rstrip() if covered else text


def dedup_substrings(docs: DataFrame, run: int = RUN, words: int = WORDS, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_removed, removed, text) of every document.

    ``removed`` lists the stretches taken out as start:end in code points of the
    old text, comma-joined; ``text`` is what is left. n_removed counts the
    sentences taken out. Null and empty texts stay as they are; texts shorter than a span stay. Rows that share an
    id, or have none, are documents of their own as far as their texts differ;
    rows with the same id and text are one, and all lose the same sentences. An
    empty table gives an empty result; other columns are not read.
    """
    texts = _told_apart(docs, id_column, text_column)
    found = repeated_spans(texts, run, words).select(F.col("id").alias("_id"), F.col("said").alias("_said"), "repeated")
    joined = texts.join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("said") == F.col("_said")), "left").select("id", "text", "repeated")

    def make() -> Kernel:
        def kernel(batch: pa.RecordBatch) -> dict:
            out: dict = {id_column: batch.column("id"), "n_removed": [], "removed": [], "text": []}
            for text, repeated in zip(batch.column("text").to_pylist(), batch.column("repeated").to_pylist()):
                units = sentences(text) if text and repeated else []
                gone = [False] * len(units)
                for place in repeated or []:
                    first, last = place >> 32, place & 0xFFFFFFFF
                    gone[first : last + 1] = [True] * (last + 1 - first)
                stretches = stretches_of(text, units, gone) if units else []
                out["n_removed"].append(sum(gone))
                out["removed"].append(",".join(f"{a}:{b}" for a, b in stretches))
                out["text"].append(text and without(text, stretches))
            return out

        return kernel

    kind = dict(docs.dtypes)[id_column]
    ddl = f"{id_column} {kind}, n_removed bigint, removed string, text string"
    return map_slices(joined, make, ddl, 256)
