"""Packing token sequences into windows by non-negative least squares.

Every document is cut at each full window; the rest of it is one piece shorter
than a window. Combinations of a few lengths that fill a window exactly are
enumerated, how often to use each is solved as a non-negative least squares
problem against the histogram of lengths, and the counts are rounded down to
what the histogram holds. What is left is packed greedily by length. All of
that works on the histogram, whose size is the window's and not the data's;
pieces then find their places by their rank within their length.
"""

from __future__ import annotations

import json
import os
import sys
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sluice.llm.batches import Kernel, Lists, code_points, joined_ids, lists_of, map_slices, packed_lists, texts_of
from sluice.session import checkpointed

WINDOW = 2048
#: Pieces a task keeps before it starts afresh; bounds memory, not results.
MAX_PIECES = 250_000
#: Texts encoded at once.
SLICE = 512
#: Rows that one task ranks at most, on average.
RANKED_ROWS = 5_000


class PieceEncoder:
    """Ids of whole texts by a tokenizer that composes, lower-cases, and splits at white space and PIECE.

    Such a tokenizer's ids of a text are those of its white-space-separated
    chunks in turn, a chunk's those of its pieces, and both repeat. They are cut
    and told apart in Arrow, so each distinct one is looked up once in a call; those not met lately are encoded together, a
    thousand at once, and told apart by the tokens that end a word. Texts with
    the tokenizer's own marks, or with characters on which the two sides' ideas
    of white space, letters or lower case may differ, are encoded whole.
    """

    #: Fixed value: the tokenizer's own split, white space spelt out.
    PIECE = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t\n\v\f\r \p{Z}\p{L}\p{N}]+"
    DISPUTED = "\x1c\x1d\x1e\x1f\x85\u0130\u03a3"
    TOGETHER = 1_000

    def __init__(self, definition: str):
        # a worker has one core, and every further thread keeps memory of its own
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        given = json.loads(definition)
        self.marks = [a["content"] for a in given.get("added_tokens", [])]
        #: Of every code point whether it is disputed, or unknown to this Python's tables and so perhaps a letter in others.
        self.disputed = np.array([unicodedata.category(chr(c)) == "Cn" for c in range(sys.maxunicode + 1)])
        self.disputed[list(map(ord, self.DISPUTED))] = True
        model = given["model"]
        suffix = model["end_of_word_suffix"]
        self.ends = np.zeros(max(model["vocab"].values()) + 1, bool)
        self.ends[[i for t, i in model["vocab"].items() if t.endswith(suffix)]] = True
        #: Pieces met lately, and those before them.
        self.known: dict[str, bytes] = {}
        self.former: dict[str, bytes] = {}

    def forget(self) -> None:
        self.former = {}

    def odd(self, text: str) -> bool:
        return bool(self.disputed[code_points(text)].any()) or any(m in text for m in self.marks)

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> None:
        known = self.known
        parts = [pieces[i : i + self.TOGETHER] for i in range(0, len(pieces), self.TOGETHER)]
        for part, e in zip(parts, self.tokenizer.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            cuts = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(cuts) == len(part):
                packed, at = ids.tobytes(), 0
                for piece, cut in zip(part, cuts.tolist()):
                    known[piece] = packed[at:cut]
                    at = cut
            else:
                known.update(zip(part, self.whole(part)))

    def ids_of(self, pieces: list[str]) -> list[bytes]:
        known, former = self.known, self.former
        known[""] = b""  # white space at a text's ends leaves empty pieces
        found = list(map(known.get, pieces))
        if None in found:
            new = [p for p, ids in zip(pieces, found) if ids is None]
            known.update((p, former[p]) for p in new if p in former)
            self.learn([p for p in new if p not in known])
            found = list(map(known.__getitem__, pieces))
        return found

    def ids_of_chunks(self, chunks: pa.Array) -> Lists:
        pieces = pc.utf8_split_whitespace(pc.replace_substring_regex(chunks, self.PIECE, r"\0 "))
        return joined_ids(pieces, lambda distinct: lists_of(self.ids_of(distinct.to_pylist())))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        if len(self.known) > MAX_PIECES:
            self.former, self.known = self.known, {}
        odd = {i for i, t in enumerate(texts) if self.odd(t)}
        plain = pa.array(["" if i in odd else unicodedata.normalize("NFC", t).lower() for i, t in enumerate(texts)], pa.large_string())
        out = packed_lists(joined_ids(pc.utf8_split_whitespace(plain), self.ids_of_chunks))
        for i, whole in zip(sorted(odd), self.whole([texts[i] for i in sorted(odd)])):
            out[i] = whole
        return out


_MADE: dict[int, PieceEncoder] = {}


def _encoder(definition: str) -> PieceEncoder:
    """Made once in each Python worker."""
    key = hash(definition)
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = PieceEncoder(definition)
    return _MADE[key]


def pieces(df: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens): each document's ids and the end id, cut at every full window."""
    definition = open(tokenizer_path, encoding="utf-8").read()
    last = np.array([end_id], "<u4").tobytes()

    def make() -> Kernel:
        encoder = _encoder(definition)

        def kernel(batch: pa.RecordBatch) -> dict:
            rows: list[list[int]] = [[], [], [], [], []]
            for k, ids in enumerate(encoder.encode(texts_of(batch, text_column))):
                ids += last
                total = len(ids) // 4
                for start in range(0, total, window):
                    part = ids[4 * start : 4 * (start + window)]
                    for column, value in zip(rows, (k, start, len(part) // 4, zlib.crc32(part), total)):
                        column.append(value)
            names = ("start", "length", "ids_crc32", "doc_tokens")
            return {id_column: batch.column(id_column).take(pa.array(rows[0], pa.int64()))} | dict(zip(names, rows[1:]))

        kernel.release = encoder.forget
        return kernel

    kind = dict(df.dtypes)[id_column]
    ddl = f"{id_column} {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return map_slices(df.select(id_column, text_column), make, ddl, SLICE)


def combinations(window: int, lengths: np.ndarray, weight: np.ndarray, depth: int = 3, most: int = 4096) -> list[tuple[int, ...]]:
    """Up to ``depth`` present lengths that sum to the window: all pairs, and the triples
    whose rarest length is most frequent, ``most`` in all."""
    present = set(lengths.tolist())
    count = dict(zip(lengths.tolist(), weight.tolist()))
    found = [(a, window - a) for a in sorted(present) if 2 * a >= window and window - a in present]
    if depth >= 3:
        frequent = sorted(present, key=lambda n: (-count[n], n))[:192]
        triples = {
            tuple(sorted((a, b, window - a - b), reverse=True))
            for i, a in enumerate(frequent)
            for b in frequent[i:]
            if window - a - b in present
        }
        found += sorted(triples, key=lambda t: (-min(count[n] for n in t), t))[: max(0, most - len(found))]
    return found


def nnls(columns: list[tuple[int, ...]], target: np.ndarray, rounds: int = 200) -> np.ndarray:
    """min |A x - target| over x >= 0, column j of A counting the lengths of combination j.

    Projected coordinate descent on the sparse columns: each step is the exact
    minimum over one coordinate.
    """
    rest = target.astype(float).copy()
    x = np.zeros(len(columns))
    sparse = [np.unique(np.array(c), return_counts=True) for c in columns]
    for _ in range(rounds):
        moved = 0.0
        for j, (at, n) in enumerate(sparse):
            step = max(-x[j], float(rest[at] @ n) / float(n @ n))
            if step:
                x[j] += step
                rest[at] -= step * n
                moved = max(moved, abs(step))
        if moved < 0.25:
            break
    return x


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int]]:
    """Where the pieces of each length go: (length, first rank, ranks, first sequence, offset, pieces a sequence).

    The k-th of the ranks goes to sequence first + k // pieces, at the offset
    plus length * (k % pieces). Bounded by the window alone.
    """
    left = np.zeros(window + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    used = np.zeros_like(left)
    out: list[tuple[int, int, int, int, int, int]] = []
    sequences = 0

    def use(pattern: list[tuple[int, int]], times: int) -> None:
        nonlocal sequences
        offset = 0
        for length, n in pattern:
            out.append((length, int(used[length]), times * n, sequences, offset, n))
            used[length] += times * n
            left[length] -= times * n
            offset += length * n
        sequences += times

    if left[window]:
        use([(window, 1)], int(left[window]))
    lengths = np.flatnonzero(left[:window])
    columns = combinations(window, lengths, left[lengths])
    for pattern, x in zip(columns, nnls(columns, left)):
        at, n = np.unique(np.array(pattern), return_counts=True)
        times = min(int(x), int((left[at] // n).min()))
        if times > 0:
            use([(int(a), int(k)) for a, k in zip(at[::-1], n[::-1])], times)
    # greedily: the longest piece, then the longest that still fits; a pattern is repeated as long as its pieces last
    while left.any():
        pattern, gap = [], window
        while gap and (fit := np.flatnonzero(left[: gap + 1])).size:
            length = int(fit[-1])
            n = min(gap // length, int(left[length]))
            if pattern == [] and n * length < window:
                n = 1  # let a shorter piece share the window with the longest
            pattern.append((length, n))
            left[length] -= n
            gap -= n * length
        for length, n in pattern:
            left[length] += n
        merged: dict[int, int] = {}
        for length, n in pattern:
            merged[length] = merged.get(length, 0) + n
        use(list(merged.items()), min(int(left[length]) // n for length, n in merged.items()))
    return out


def ranked(rows: DataFrame, key: str, order: list[str], counts: dict[int, int]) -> DataFrame:
    """A rank from 0 among the rows of each key, in ``rank``; ``counts`` says how many rows each key, a small number, has.

    Rows are dealt into bins by hash of their order, a key with more rows into
    more of them, so no task ranks a whole key; a bin's ranks follow those of
    the bins before it, whose sizes are counted.
    """
    several = F.lit([max(1, -(-counts.get(k, 0) // RANKED_ROWS)) for k in range(max([0, *counts]) + 1)])
    dealt = rows.withColumn("bin", F.pmod(F.xxhash64(*order), F.get(several, F.col(key).cast("int"))).cast("int"))
    sizes = dealt.groupBy(key, "bin").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(key).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(key, "bin", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy(key, "bin").orderBy(*order)
    return (
        dealt.withColumn("own", F.row_number().over(own) - 1)
        .join(firsts, [key, "bin"])
        .withColumn("rank", F.col("own") + F.col("first"))
        .drop("own", "first", "bin")
    )


def pack(df: DataFrame, tokenizer_path: str, end_id: int, window: int = WINDOW, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    Null texts count as empty: a document of the end id alone. Repeated rows are
    packed as often as they occur, an empty table gives an empty result, other
    columns are not read. Only the histogram of lengths, at most ``window``
    numbers, comes to the driver.
    """
    found = checkpointed(pieces(df, tokenizer_path, end_id, window, id_column, text_column))
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = np.array(plan(histogram, window), np.int64).reshape(-1, 6)
    places = places[np.lexsort((places[:, 1], places[:, 0]))]
    # one sorted key: length, then first rank
    most = max([1, *histogram.values()]) + 1
    keys = places[:, 0] * most + places[:, 1]
    rows = ranked(found, "length", [id_column, "start", "ids_crc32"], histogram)
    schema = T.StructType([*found.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = found.columns

    def make() -> Kernel:
        def kernel(batch: pa.RecordBatch) -> dict:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            place = places[np.searchsorted(keys, length * most + rank, "right") - 1]
            k = rank - place[:, 1]
            return {n: batch.column(n) for n in names} | {
                "sequence_id": place[:, 3] + k // place[:, 5],
                "offset": place[:, 4] + length * (k % place[:, 5]),
            }

        return kernel

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return map_slices(rows.select(*names, "rank"), make, ddl, 8192)
