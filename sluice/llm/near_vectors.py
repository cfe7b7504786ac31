"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction, and a vector passes it when its inner product reaches
a threshold. Directions come from random product codes: two short codes, one
for each half of the turned dimensions, and every choice of a word from each is
a direction. A vector is list-decoded to all directions it passes: from two
sorted lists of scores, sums are taken while they reach the threshold. Vectors
that share a direction meet, and their cosine is computed in double precision.

The threshold is the one that a random unit vector reaches for PASSES
directions on average. That alone leaves a vector far from all directions with
none, and so a fifth of pairs at the least cosine without a shared one: the
FLOOR best directions of a vector count as passed whatever their scores. How
many pairs that finds is measured in the tests; the directions grow with the
root of the table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.batches import Kernel, map_slices
from sluice.llm.components import components
from sluice.llm.vectors import matrix
from sluice.session import checkpointed

CODES = 3
#: Directions that a random vector passes on average, and those that any vector passes at least.
PASSES, FLOOR = 24, 16
#: Random vectors from which the threshold is taken, and the largest product of ranks looked at for it.
SAMPLE, RANKS = 256, 256
#: Words of a code for up to 50,000 rows.
WORDS = 20
#: Rows of a bucket that one task compares with as many others.
CELL_ROWS = 2_000
#: Parts of a group of equal vectors.
COPY_BINS = 64


class ProductCodes:
    def __init__(self, width: int, rows: int, passes: int = PASSES, floor: int = FLOOR, seed: int = 7):
        random = np.random.default_rng(seed)
        self.width = max(width, 1)
        self.words = math.ceil(WORDS * max(1.0, rows / 50_000) ** 0.25)
        self.cut = (self.width + 1) // 2
        self.turns, self.codes = [], []
        for _ in range(CODES):
            self.turns.append(np.linalg.qr(random.normal(size=(self.width, self.width)))[0])
            pair = []
            for size in (self.cut, self.width - self.cut):
                code = random.normal(size=(self.words, size))
                pair.append(code / np.maximum(np.linalg.norm(code, axis=1, keepdims=True), 1e-300) * math.sqrt(size))
            self.codes.append(pair)
        self.floor = floor
        sample = random.normal(size=(SAMPLE, self.width))
        best = np.sort(self.best(self.lists(sample / np.linalg.norm(sample, axis=1, keepdims=True)), RANKS).ravel())
        self.threshold = best[-min(len(best), SAMPLE * passes)]

    def lists(self, unit: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of every code the scores of both halves' words, best first, and which words they are."""
        out = []
        for turn, (front, back) in zip(self.turns, self.codes):
            turned = unit @ turn
            halves = turned[:, : self.cut] @ front.T, turned[:, self.cut :] @ back.T
            order = [np.argsort(-h, axis=1, kind="stable") for h in halves]
            out.append((*(np.take_along_axis(h, o, 1) for h, o in zip(halves, order)), *order))
        return out

    def best(self, lists: list, ranks: int) -> np.ndarray:
        """The best scores of each row: of two sorted lists only pairs whose ranks multiply to at most ``ranks`` are among the best of so many."""
        pairs = [(i, j) for i in range(self.words) for j in range(self.words) if (i + 1) * (j + 1) <= ranks]
        i, j = (np.array(r) for r in zip(*pairs))
        return np.concatenate([a[:, i] + b[:, j] for a, b, _, _ in lists], 1)

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """The directions that each row passes, sorted."""
        lists = self.lists(unit)
        score = self.best(lists, self.floor)
        k = min(self.floor, score.shape[1])
        least = np.minimum(np.partition(score, -k, axis=1)[:, -k], self.threshold)
        rows, directions = [], []
        for c, (a, b, first, second) in enumerate(lists):
            for i in range(self.words):
                live = np.flatnonzero(a[:, i] + b[:, 0] >= least)
                if not len(live):
                    break
                for j in range(self.words):
                    live = live[a[live, i] + b[live, j] >= least[live]]
                    if not len(live):
                        break
                    rows.append(live)
                    directions.append((c * self.words + first[live, i]) * self.words + second[live, j])
        row = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        direction = np.concatenate(directions).astype("<i4") if rows else np.zeros(0, "<i4")
        order = np.lexsort((direction, row))
        return np.split(direction[order], np.searchsorted(row[order], np.arange(1, len(unit)))) if len(unit) else []


def first_shared(mine: list[np.ndarray], theirs: list[np.ndarray], direction: int) -> np.ndarray:
    """Which pairs share no direction before this one."""
    before = [[d[d < direction] for d in side] for side in (mine, theirs)]
    shared = np.intersect1d(np.concatenate(before[0] or [[]]), np.concatenate(before[1] or [[]]))
    if not len(shared):
        return np.ones((len(mine), len(theirs)), bool)
    flags = []
    for side in before:
        flag = np.zeros((len(side), len(shared)), np.float32)
        for k, d in enumerate(side):
            at = np.searchsorted(shared, d)
            at[at == len(shared)] = 0
            flag[k, at[shared[at] == d]] = 1
        flags.append(flag)
    return flags[0] @ flags[1].T == 0


def forest(linked: np.ndarray, mine: np.ndarray, theirs: np.ndarray, same: bool) -> list[tuple[int, int]]:
    """Edges that connect what the links of two blocks connect: one fewer than there are vertices in each component."""
    out = []
    todo = linked.any(1)
    while todo.any():
        row = np.zeros(len(mine), bool)
        row[np.argmax(todo)] = True
        column = np.zeros(len(theirs), bool)
        while True:
            wide = linked[row].any(0)
            tall = linked[:, wide].any(1) | row
            if same:
                wide = tall = wide | tall
            if (wide == column).all() and (tall == row).all():
                break
            row, column = tall, wide
        members = np.unique(np.concatenate([mine[row], theirs[column]]))
        out += [(int(members[0]), int(m)) for m in members[1:]]
        todo &= ~row
    return out


def near_vectors(df: DataFrame, cosine: float = 0.95, passes: int = PASSES, floor: int = FLOOR, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    n_links counts the other rows linked directly (found with a cosine of at
    least ``cosine``); component_id is the smallest id reachable by links, the
    own one included. Null, zero, and non-finite vectors link with nothing.
    Equal vectors, told by 128 bits of a hash, are compared once and share
    their links; rows with one id are one vertex; rows with a null id link with
    nothing and have no component. A bucket larger than CELL_ROWS is split into
    blocks, and pairs of blocks are the tasks: no pair is left out, none is sent
    on, only counts and spanning edges are.
    """
    rows = df.count()
    named = df.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(F.min(vector_column).alias("vector"))
    # vectors that can't link are alone; the others are dealt into bins, so no task gathers all copies of one
    usable = F.col("vector").isNotNull() & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("vector", lambda x: x != 0)
    key = ["high", "low"]
    once = checkpointed(named.withColumn("usable", F.coalesce(usable, F.lit(False))).withColumn("high", F.xxhash64("vector", F.lit(1))).withColumn("low", F.xxhash64("vector", F.lit(2))))
    dealt = once.where("usable").select("id", *key, F.pmod(F.xxhash64("id"), F.lit(COPY_BINS)).alias("bin"))
    bins = dealt.groupBy(*key, "bin").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    firsts = checkpointed(bins.groupBy(*key).agg(F.min("least").alias("first"), F.sum("n").alias("copies")))
    same = once.where("usable").join(firsts.select(F.col("first").alias("id"), "copies"), "id").select("id", "copies", F.col("vector").alias(vector_column))
    first = df.select(F.max(F.size(vector_column)).alias("n")).first()["n"] or 0
    code = ProductCodes(int(first), rows, passes, floor)
    packed_as = "<f4" if "float" in dict(df.dtypes)[vector_column] else "<f8"

    def make() -> Kernel:
        def kernel(batch: pa.RecordBatch) -> dict:
            values, whole = matrix(batch.column(vector_column))
            if values.shape[1] < code.width:
                values = np.pad(values, ((0, 0), (0, code.width - values.shape[1])))
            norm = np.linalg.norm(values, axis=1)
            at = np.flatnonzero(whole & (norm > 0) & np.isfinite(norm))
            passed = code.decode(values[at] / norm[at, None]) if len(at) else []
            row = np.repeat(np.arange(len(at)), [len(p) for p in passed])
            vectors, lists = [v.tobytes() for v in values[at].astype(packed_as)], [p.tobytes() for p in passed]
            ids, copies = batch.column("id").to_numpy()[at], batch.column("copies").to_numpy()[at]
            return {
                "direction": np.concatenate(passed).astype(np.int64) if passed else [],
                "id": ids[row],
                "copies": copies[row],
                "vector": [vectors[r] for r in row],
                "passed": [lists[r] for r in row],
            }

        return kernel

    met = checkpointed(map_slices(same, make, "direction bigint, id bigint, copies bigint, vector binary, passed binary"))
    sizes = met.groupBy("direction").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / CELL_ROWS).cast("int")
    cells = (
        met.join(sizes, "direction")
        .withColumn("parts", parts)
        .withColumn("own", F.pmod(F.xxhash64("id", "direction"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("direction", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "id", "copies", "vector", "passed")
    )

    def compare(key, table):
        direction, low, high = (k.as_py() for k in key)
        own = table.column("own").to_numpy()
        ids, copies = table.column("id").to_numpy(), table.column("copies").to_numpy()
        vectors = np.frombuffer(b"".join(table.column("vector").to_pylist()), packed_as).reshape(len(ids), -1).astype(float)
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        sides = [np.flatnonzero(own == low), np.flatnonzero(own == high)]
        linked = unit[sides[0]] @ unit[sides[1]].T >= cosine
        if low == high:
            np.fill_diagonal(linked, False)
        tall, wide = linked.any(1), linked.any(0)
        out: list[tuple[int, int, int]] = []
        if tall.any():
            sides, linked = [sides[0][tall], sides[1][wide]], linked[np.ix_(tall, wide)]
            passed = table.column("passed")
            lists = [[np.frombuffer(passed[int(i)].as_py(), "<i4") for i in side] for side in sides]
            linked &= first_shared(*lists, direction)
            count: dict[int, int] = {}
            for near, far, links in ((0, 1, linked), (1, 0, linked.T)):
                if near == 0 or low != high:
                    for i, n in zip(ids[sides[near]], links @ copies[sides[far]]):
                        count[int(i)] = count.get(int(i), 0) + int(n)
            out = [(i, i, n) for i, n in count.items() if n]
            out += [(a, b, 0) for a, b in forest(linked, ids[sides[0]], ids[sides[1]], low == high)]
        a, b, n = zip(*out) if out else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    found = checkpointed(cells.groupBy("direction", "low", "high").applyInArrow(compare, "a bigint, b bigint, n bigint"))
    links = found.where("a = b").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("links"))
    groups = components(found.where("a <> b"))
    # a copy has its first one's links and the other copies
    own = (
        firsts.withColumnRenamed("first", "id")
        .join(links, "id", "left")
        .join(groups, "id", "left")
        .select(*key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component"))
    )
    linked = dealt.join(bins.select(*key, "bin").join(own, key), [*key, "bin"]).select("id", "n_links", "component")
    alone = once.where("not usable").select("id", F.lit(0).alias("n_links"), F.col("id").alias("component"))
    nameless = df.where(F.col(id_column).isNull()).select(F.col(id_column).alias("id"), F.lit(0).alias("n_links"), F.col(id_column).alias("component"))
    return linked.union(alone).union(nameless).select(
        F.col("id").alias(id_column), F.col("n_links").cast("long").alias("n_links"), F.col("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )
