"""Exact and near-duplicate elimination with first-wins semantics."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from sluice.operators.order import ranked
from sluice.session import checkpointed, ship

#: Keys that one row may look up; the list of what they differ in is sent to every task.
MAX_FLIPS = 100_000
#: Rows of a block that is compared with another, and how many comparisons of hashes cost as much as one more row of a cell.
BLOCK_ROWS, ROW_COST = 16_384, 1_500
#: Hashes compared at once, pairs held before they are passed on, and comparisons of one task.
COMPARED_AT_ONCE, HELD_PAIRS, TASK_COMPARISONS = 1 << 18, 200_000, 10_000_000_000
#: Rows of one hash that are paired with others in one task.
CROWD = 500


def first_by_key(df: DataFrame, key: str, order: str, copies: str | None = None) -> DataFrame:
    """One row (key, order) per key: the smallest order value wins; ``copies`` names a column with the number of the key's rows.

    A plain aggregate, so copies are combined before the shuffle and a key that
    holds a third of all rows sends one row per task. Null keys form one group.
    """
    return df.groupBy(key).agg(F.min(order).alias(order), *([F.count(F.lit(1)).alias(copies)] if copies else []))


def first_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """The whole first row of each key, by an aggregate of structs."""
    rest = [c for c in df.columns if c not in (key, order)]
    row = F.min_by(F.struct(*rest), F.col(order)) if rest else F.lit(None)
    out = df.groupBy(key).agg(F.min(order).alias(order), row.alias("_row"))
    return out.select(*(F.col(f"_row.{c}").alias(c) if c in rest else F.col(c) for c in df.columns))


def ordered_union_distinct(frames: list[DataFrame], key: str, order: str = "pos") -> DataFrame:
    """The frames one after the other, and of each key only the first row: by frame, then by the order within it."""
    tagged = [f.withColumn("_frame", F.lit(i)) for i, f in enumerate(frames)]
    union = tagged[0]
    for f in tagged[1:]:
        union = union.unionByName(f, allowMissingColumns=True)
    union = union.withColumn("_place", F.struct("_frame", order))
    return first_rows(union, key, "_place").drop("_place", "_frame")


def band_masks(rows: int, threshold: int, bits: int, most: int = 4) -> list[int]:
    """The bits that pairs within a threshold may be joined on: every choice of g among threshold + g bands, as signed longs."""
    return _best_masks(rows, threshold, bits, most)[1]


def _best_masks(rows: int, threshold: int, bits: int, most: int) -> tuple[float, list[int]]:
    best = None
    for g in range(1, most + 1):
        bands = threshold + g
        cuts = [bits * k // bands for k in range(bands + 1)]
        parts = [((1 << (hi - lo)) - 1) << lo for lo, hi in zip(cuts, cuts[1:])]
        masks = [sum(choice) for choice in combinations(parts, g)]
        cost = rows * len(masks) + sum(rows * rows / 2 ** (1 + m.bit_count()) for m in masks)
        if best is None or cost < best[0]:
            best = cost, masks
    return best[0], sorted({_signed(m) for m in best[1]})


@dataclass(frozen=True)
class Probing:
    """Bands of bits, each looked up with all keys within a number of flips."""

    masks: tuple[int, ...]
    radii: tuple[int, ...]
    flips: int
    meetings: float


def probing(threshold: int, bits: int, bands: int) -> Probing:
    """Pairs within t bits are within r_i of each other in one of m bands at least, for any radii that sum to t - m + 1."""
    cuts = [bits * k // bands for k in range(bands + 1)]
    left = max(0, threshold - bands + 1)
    radii = tuple(left // bands + (i < left % bands) for i in range(bands))
    widths = [hi - lo for lo, hi in zip(cuts, cuts[1:])]
    keys = [sum(comb(w, k) for k in range(min(r, w) + 1)) for w, r in zip(widths, radii)]
    masks = tuple(((1 << w) - 1) << lo for w, lo in zip(widths, cuts))
    return Probing(masks, radii, sum(keys), sum(n / 2**w for n, w in zip(keys, widths)))


def best_probing(rows: int, threshold: int, bits: int, most: int = 16) -> tuple[float, Probing] | None:
    """(expected rows and meetings, bands) of the best number of bands whose flips may be sent to every task; None where none may."""
    found = [probing(threshold, bits, m) for m in range(1, min(most, bits, threshold + 1) + 1)]
    costs = [(rows * (len(p.masks) + p.flips) + rows * rows / 2 * p.meetings, p) for p in found if p.flips <= MAX_FLIPS]
    return min(costs, key=lambda c: c[0], default=None)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _probed(base: DataFrame, plan: Probing) -> DataFrame:
    """(a, ha, b, hb) of all that meet when each row looks its bands up within their radii; both orders."""
    masks = F.array(*(F.lit(_signed(m)) for m in plan.masks))
    banded = base.select("id", "h", F.inline(F.transform(masks, lambda m, k: F.struct(k.alias("band"), F.col("h").bitwiseAND(m).alias("bits")))))
    rows = []
    for band, (mask, radius) in enumerate(zip(plan.masks, plan.radii)):
        places = [1 << k for k in range(64) if mask >> k & 1]
        rows += [(band, _signed(sum(c))) for r in range(radius + 1) for c in combinations(places, r)]
    flips = base.sparkSession.createDataFrame(rows, "band int, flip long")
    asked = banded.join(F.broadcast(flips), "band").select(F.col("id").alias("a"), F.col("h").alias("ha"), "band", F.col("bits").bitwiseXOR(F.col("flip")).alias("bits"))
    return asked.join(banded.select(F.col("id").alias("b"), F.col("h").alias("hb"), "band", "bits"), ["band", "bits"])


def compared_masks(rows: int, threshold: int, bits: int, most: int = 4) -> tuple[float, list[int]]:
    """(cost in comparisons, masks) of the best choice of bits whose cells are compared row by row: none, so all in one cell, or g among threshold + g bands."""
    found = [(rows * max(1, rows / BLOCK_ROWS) * ROW_COST + rows * rows / 2, [0])]
    for g in range(1, most + 1):
        cuts = [bits * k // (threshold + g) for k in range(threshold + g + 1)]
        masks = [sum(choice) for choice in combinations([(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])], g)]
        cells = [rows / 2 ** m.bit_count() for m in masks]
        found.append((sum(rows * max(1, c / BLOCK_ROWS) * ROW_COST + rows * c / 2 for c in cells), sorted({_signed(m) for m in masks})))
    return min(found, key=lambda c: c[0])


def _hits(left: np.ndarray, right: np.ndarray, threshold: int, within: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places on the left, on the right) of what is within a threshold, some rows after the other; of a block with itself each pair once."""
    step = max(1, COMPARED_AT_ONCE // max(1, len(right)))
    for start in range(0, len(left), step):
        others = right[start:] if within else right
        near = np.bitwise_count(left[start : start + step, None] ^ others) <= threshold
        rows, columns = np.divmod(np.flatnonzero(near), len(others))
        if within:
            rows, columns = rows[columns > rows], columns[columns > rows] + start
        if len(rows):
            yield rows + start, columns


def _compared(base: DataFrame, masks: list[int], threshold: int, rows: int, cost: float) -> DataFrame:
    """(a, b, distance) of the pairs within a threshold among rows of different hashes, each pair once and in any order.

    Rows that agree on a mask's bits form a cell, which one task compares by
    their hashes alone. A cell of more than BLOCK_ROWS rows is cut into blocks,
    and each two blocks are compared on their own. A pair that agrees on several
    masks counts for the first of them.
    """
    spark = base.sparkSession
    ship(spark)
    keys = F.transform(F.array(*(F.lit(m) for m in masks)), lambda m, k: F.struct(k.alias("band"), F.col("h").bitwiseAND(m).alias("bits")))
    cells = base.select("id", "h", F.inline(keys)).withColumn("own", F.lit(0)).withColumn("i", F.lit(0)).withColumn("j", F.lit(0))
    if rows > BLOCK_ROWS:
        large = cells.groupBy("band", "bits").count().where(F.col("count") > BLOCK_ROWS).select("band", "bits", F.ceil(F.col("count") / BLOCK_ROWS).cast("int").alias("blocks"))
        # a table of rows * masks / BLOCK_ROWS rows at most
        own = F.pmod(F.xxhash64("h"), F.coalesce("blocks", F.lit(1))).cast("int")
        with_own = cells.drop("own", "i", "j").join(F.broadcast(large), ["band", "bits"], "left").withColumn("own", own)
        other = with_own.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
        cells = other.select("id", "h", "band", "bits", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    before = np.array(masks, np.int64)

    def compared(part: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = part.column("id").combine_chunks()
        h, band, own, i, j = (part.column(c).to_numpy() for c in ("h", "band", "own", "i", "j"))
        h = h.view(np.uint64)
        starts = np.append(_starts(part), len(h))
        out, held = [], 0
        for k in np.flatnonzero(np.diff(starts) > 1).tolist():
            a, b = int(starts[k]), int(starts[k + 1])
            within = i[a] == j[a]
            first = second = np.arange(a, b)
            if not within:
                first, second = first[own[a:b] == i[a]], second[own[a:b] == j[a]]
            for left, right in _hits(h[first], h[second], threshold, within):
                left, right = first[left], second[right]
                apart = h[left] ^ h[right]
                new = ~((apart.view(np.int64)[:, None] & before[None, : band[a]]) == 0).any(1)
                out.append((left[new], right[new]))
                held += len(out[-1][0])
                if held > HELD_PAIRS:
                    yield said(ids, h, out)
                    out, held = [], 0
        if held:
            yield said(ids, h, out)

    def said(ids: pa.Array, h: np.ndarray, out: list) -> pa.RecordBatch:
        left, right = (np.concatenate(x) for x in zip(*out))
        distance = np.bitwise_count(h[left] ^ h[right]).astype(np.int32)
        return pa.RecordBatch.from_arrays([ids.take(pa.array(left)), ids.take(pa.array(right)), pa.array(distance)], ["a", "b", "distance"])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, enough = [], 0, 2 * BLOCK_ROWS
        for batch in source:
            held.append(batch)
            size += batch.num_rows
            if size >= enough:  # the last cell may go on
                part = pa.Table.from_batches(held).combine_chunks()
                cut = int(_starts(part)[-1])
                yield from compared(part.slice(0, cut))
                held, size = part.slice(cut).combine_chunks().to_batches(), part.num_rows - cut
                enough = 2 * max(BLOCK_ROWS, size)
        if size:
            yield from compared(pa.Table.from_batches(held).combine_chunks())

    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(cost / TASK_COMPARISONS))
    cell = ["band", "bits", "i", "j"]
    schema = StructType([StructField("a", base.schema["id"].dataType), StructField("b", base.schema["id"].dataType), StructField("distance", IntegerType())])
    return cells.repartition(tasks, *cell).sortWithinPartitions(*cell).mapInArrow(run, schema)


def _starts(part: pa.Table) -> np.ndarray:
    """Where the cells of sorted rows begin."""
    new = np.zeros(part.num_rows, bool)
    new[:1] = True
    for name in ("band", "bits", "i", "j"):
        column = part.column(name).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def distinct_pairs(base: DataFrame, threshold: int, bits: int, probe: int | None = None) -> DataFrame:
    """(a, b, distance), a < b, of the pairs within a threshold among rows (id, h) of different hashes, exactly and each once.

    A pair within t bits agrees on g of t + g bands at least, so it meets in the
    cell of a choice of g bands, where rows are compared one with the other: more
    keys for each row as g grows, but smaller cells; with g = 0 all is one cell,
    cut into blocks. And of m bands it has one in which it differs in t // m bits
    or fewer, so it meets where each row looks up all keys that near: few wide
    bands, many probes. What costs least by the expected number of rows and
    comparisons is taken; ``probe`` sets m instead.
    """
    rows = base.count()
    cost, masks = compared_masks(rows, threshold, bits)
    best = best_probing(rows, threshold, bits)
    if probe or (best and best[0] * ROW_COST < cost):
        met = _probed(base, probing(threshold, bits, probe) if probe else best[1])
        distance = F.bit_count(F.col("ha").bitwiseXOR(F.col("hb")))
        return met.where((F.col("a") < F.col("b")) & (distance <= threshold)).select("a", "b", distance.cast("int").alias("distance")).distinct()
    return _compared(base, masks, threshold, rows, cost).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "distance")


def hamming_pairs(df: DataFrame, threshold: int, id_column: str = "id", hash_column: str = "h", bits: int = 64, probe: int | None = None) -> DataFrame:
    """(a, b, distance) of every pair a < b within a threshold, exactly.

    Equal hashes are compared once (``distinct_pairs``); the rows of two near
    hashes, and those of one, are then paired by joins. A hash of more than
    CROWD rows is joined in parts.
    """
    base = checkpointed(df.where(F.col(hash_column).isNotNull()).select(F.col(id_column).alias("id"), F.col(hash_column).cast("long").alias("h")).where("id is not null").distinct())
    sizes = checkpointed(base.groupBy("h").count())
    near = distinct_pairs(sizes.select(F.col("h").alias("id"), "h"), threshold, bits, probe)
    links = near.union(sizes.where("count > 1").select(F.col("h").alias("a"), F.col("h").alias("b"), F.lit(0).alias("distance")))
    crowds = F.broadcast(sizes.where(F.col("count") > CROWD).select(F.col("h").alias("of"), F.ceil(F.col("count") / CROWD).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    left = base.select(F.col("id").alias("x"), F.col("h").alias("ha"))
    right = base.join(crowds, F.col("h") == F.col("of"), "left").select(F.col("id").alias("y"), F.col("h").alias("hb"), F.pmod(F.xxhash64("id"), parts).cast("int").alias("part"))
    asked = links.select(F.col("a").alias("ha"), F.col("b").alias("hb"), "distance").join(crowds, F.col("hb") == F.col("of"), "left")
    asked = asked.select("ha", "hb", "distance", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    met = asked.join(left, "ha").join(right, ["hb", "part"]).where("x < y or (x > y and ha <> hb)")
    pairs = met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "distance")
    return pairs if base.select("id").distinct().count() == base.count() else pairs.distinct()


def near_dup_greedy(df: DataFrame, threshold: int = 8, id_column: str = "id", hash_column: str = "h", bits: int = 64) -> DataFrame:
    """(id, fate): in order of id, a row is kept iff no kept row before it is within the threshold.

    fate is 'kept', 'duplicate' or, without a hash, 'null_hash'. A threshold of
    0 or None means 8. The result is the lexicographically first maximal
    independent set of the graph of near pairs. Equal hashes are collapsed to
    their first row, which decides for all of them. Each round keeps every row
    all of whose earlier neighbours are gone and drops the later neighbours of
    kept rows; rounds are bounded by the longest chain of decisions, lineage is
    cut by a checkpoint in each.
    """
    threshold = threshold or 8
    base = df.select(F.col(id_column).alias("id"), F.col(hash_column).cast("long").alias("h"))
    firsts = checkpointed(first_by_key(base.where("h is not null"), "h", "id"))
    edges = checkpointed(distinct_pairs(firsts.where("id is not null"), threshold, bits).select("a", "b"))
    decided = None
    while edges.limit(1).count():
        later = edges.select(F.col("b").alias("id")).distinct()
        # rows with only later neighbours are kept, and those neighbours dropped
        heads = edges.select(F.col("a").alias("id")).distinct().join(later, "id", "left_anti")
        gone = edges.join(heads.select(F.col("id").alias("a")), "a").select(F.col("b").alias("id")).distinct()
        gone = checkpointed(gone)
        decided = gone if decided is None else decided.union(gone)
        edges = checkpointed(
            edges.join(gone.select(F.col("id").alias("a")), "a", "left_anti")
            .join(gone.select(F.col("id").alias("b")), "b", "left_anti")
            .join(heads.select(F.col("id").alias("a")), "a", "left_anti")
            .select("a", "b")
        )
    kept = firsts.select("id") if decided is None else firsts.select("id").join(decided, "id", "left_anti")
    marked = base.join(kept.withColumn("in", F.lit(True)), "id", "left")
    fate = F.when(F.col("h").isNull(), "null_hash").when(F.col("in"), "kept").otherwise("duplicate")
    return marked.select("id", fate.alias("fate"))


def content_key(df: DataFrame, content: str, algorithm: str = "md5") -> DataFrame:
    """A digest of the content in ``digest``: md5, or sha with its bits (sha256)."""
    value = F.md5(content) if algorithm == "md5" else F.sha2(content, int(algorithm.removeprefix("sha")))
    return df.withColumn("digest", value)


def numbered_firsts(df: DataFrame, key: str, order: str) -> DataFrame:
    """Every row with its number among those of its key, from 1, in ``occurrence``."""
    return ranked(df, [key], [order], "occurrence").withColumn("occurrence", F.col("occurrence") + 1)
