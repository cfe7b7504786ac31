"""Document fingerprints: bottom-k sketches of word shingles.

A sketch is the K least 63-bit hashes of a text's distinct shingles, in order;
with fewer than K it is the whole set and all estimates are exact. Sketches of
parts merge into the sketch of the whole, so they can be taken of any split of
the data and combined in any order. Two of them estimate resemblance (Jaccard
similarity) and containment, one the number of distinct shingles.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.llm.batches import Kernel, map_slices, texts_of
from sluice.llm.shingle_join import WordHashes, shingle_hashes, words_of

#: Words in a shingle, and hashes in a sketch: a resemblance of 0.8 has a standard error of 0.035.
WORDS, K = 5, 128
#: Rows in a range of the documents' order, on average; a range is one task.
RANGE_ROWS = 20_000
#: Hashes are less than this.
SPACE = float(1 << 63)


def sketch_of(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """The k least of some 64-bit hashes, each once, as signed numbers of 63 bits."""
    return np.unique(hashes >> np.uint64(1))[:k].astype(np.int64)


def merge(sketches: list[np.ndarray], k: int = K) -> np.ndarray:
    """The sketch of all that some sketches stand for."""
    return np.unique(np.concatenate([np.empty(0, np.int64), *sketches]))[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """The share of the union that is in both; two empty sets are alike (1)."""
    if not len(a) and not len(b):
        return 1.0
    least = merge([a, b], k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(least, both, assume_unique=True).mean())


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """How many distinct shingles a sketch stands for."""
    return float(len(a)) if len(a) < k else (k - 1) * SPACE / float(a[-1])


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """The share of a's shingles that are also b's; an empty set is in all others."""
    if not len(a):
        return 1.0
    if not len(b):
        return 0.0
    # up to the lesser of both ends each sketch is its whole set
    end = min(x[-1] if len(x) == k else np.iinfo(np.int64).max for x in (a, b))
    own = a[a <= end]
    if len(own):
        return float(np.isin(own, b, assume_unique=True).mean())
    return min(1.0, resemblance(a, b, k) * distinct_shingles(merge([a, b], k), k) / distinct_shingles(a, k))


def written(sketch: np.ndarray) -> str:
    """A sketch as text: its hashes, little-endian, in base 64."""
    return base64.b64encode(sketch.astype("<i8").tobytes()).decode()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), "<i8").astype(np.int64)


class Sketcher:
    """Sketches of whole texts: shingles of ``words`` words, of all where they are fewer, none without words."""

    def __init__(self, words: int = WORDS, k: int = K) -> None:
        self.words, self.k, self.hashes = words, k, WordHashes()

    def __call__(self, text: str) -> np.ndarray:
        said = words_of(text)
        return sketch_of(shingle_hashes(self.hashes(said), self.words), self.k) if said else np.empty(0, np.int64)


def fingerprints(docs: DataFrame, words: int = WORDS, k: int = K, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, sketch array<bigint>) of every row's whole text.

    Null and empty texts have an empty sketch, repeated rows stay, an empty
    table gives an empty result; other columns are not read.
    """

    def make() -> Kernel:
        sketch = Sketcher(words, k)

        def kernel(batch: pa.RecordBatch) -> dict:
            return {id_column: batch.column(id_column), "sketch": [sketch(t) for t in texts_of(batch, text_column)]}

        return kernel

    return map_slices(docs.select(id_column, text_column), make, f"{id_column} {dict(docs.dtypes)[id_column]}, sketch array<bigint>")


def merge_sketches(sketches: DataFrame, key: list[str], k: int = K, sketch: str = "sketch") -> DataFrame:
    """(key, sketch) of all rows of each key; rows with a null key are one key. Keys whose sketches are all empty have an empty one.

    No task gathers a key's sketches: a task passes on only the k least hashes
    that it has of each key, and none twice.
    """
    apart = sketches.select(*key, F.explode_outer(sketch).alias("_hash")).distinct()
    first = Window.partitionBy(*key).orderBy(F.col("_hash").asc_nulls_last())
    return (
        apart.withColumn("_rank", F.row_number().over(first))
        .where(F.col("_rank") <= k)
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list("_hash")).alias(sketch))
    )


def resemblance_of(a: Column, b: Column, k: int = K) -> Column:
    """Resemblance of two sketch columns; null where one is."""
    least = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    share = F.size(F.array_intersect(F.array_intersect(least, a), b)) / F.size(least)
    return F.when(a.isNotNull() & b.isNotNull(), F.when(F.size(least) == 0, 1.0).otherwise(share))


def distinct_of(a: Column, k: int = K) -> Column:
    """The number of distinct shingles that a sketch column stands for."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit((k - 1) * SPACE) / F.element_at(a, -1))


def _in_ranges(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(range, spare, id, text) sorted within partitions, each of one range of the descending order of (id, hash of the text), nulls last.

    The last row of a range is spare: the row that the next range begins with,
    or the first of all after the last. Only where ranges begin comes to the
    driver, a row for RANGE_ROWS.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).withColumn("h", F.xxhash64("text"))
    order = [F.col("id").desc(), F.col("h").desc()]
    keys = rows.select("id", "h")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys.count() // RANGE_ROWS))
    first = F.max(F.struct("id", "h")).alias("first")
    starts = [r["first"] for r in keys.repartitionByRange(parts, *order).groupBy(F.spark_partition_id()).agg(first).orderBy(F.col("first").desc()).collect()]
    side = math.isqrt(len(starts)) + 1
    groups = [starts[i : i + side] for i in range(0, len(starts), side)]
    pair = f"struct<id:{kind},h:bigint>"
    index = spark.createDataFrame([([g[0] for g in groups], groups)], f"pivots array<{pair}>, groups array<array<{pair}>>")
    key = F.struct("id", "h")
    upto = lambda some: F.size(F.filter(some, lambda s: s >= key))
    group = F.greatest(upto(F.col("pivots")) - 1, F.lit(0))
    placed = rows.crossJoin(F.broadcast(index)).select(  # one row
        (group * side + upto(F.get("groups", group)) - 1).cast("int").alias("range"), F.lit(0).alias("spare"), "id", "h", "text"
    )
    n = len(starts)
    heads = spark.createDataFrame([(s["id"], s["h"], (i - 1) % n) for i, s in enumerate(starts)], f"id {kind}, h bigint, range int")
    same = rows["id"].eqNullSafe(heads["id"]) & (rows["h"] == heads["h"])
    spare = (
        rows.join(F.broadcast(heads), same)
        .groupBy("range")
        .agg(F.max(rows["id"]).alias("id"), F.max(rows["h"]).alias("h"), F.max("text").alias("text"))
        .select("range", F.lit(1).alias("spare"), "id", "h", "text")
    )
    return placed.union(spare).repartitionById(max(1, n), F.col("range")).sortWithinPartitions("range", "spare", *order, "text").select("spare", "id", "text")


def edited_likeness(docs: DataFrame, words: int = WORDS, k: int = K, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_shingles, in_edited) of every row.

    The edited text is the text with its last half (rounded down, in code
    points) replaced by as many code points, or all, from the start of the next
    row's text. Next is the next smaller id, of the smallest the largest; rows
    of one id follow by the hash of their texts, rows without an id come last.
    near_edited and near_next are resemblances of the row's sketch to those of
    the edited and the next text, n_shingles and in_edited its number of
    distinct shingles and their containment in the edited text. Null texts are
    empty; equal texts have equal fingerprints, texts without a word the empty
    one; an only row is its own next; an empty table gives an empty result.
    Other columns are not read. A document's text moves once, to the task of its
    range.
    """

    def make() -> Kernel:
        sketch = Sketcher(words, k)
        waiting: list[tuple] = []

        def kernel(batch: pa.RecordBatch) -> dict:
            rows = list(zip(batch.column("id").to_pylist(), texts_of(batch), batch.column("spare").to_pylist()))
            rows = waiting + [(*row, sketch(row[1])) for row in rows]
            out: dict = {n: [] for n in names}
            for (own, text, spare, mine), (_, following, _, theirs) in zip(rows, rows[1:]):
                if spare:
                    continue
                half = len(text) // 2
                edited = text[: len(text) - half] + following[:half]
                changed = sketch(edited)
                values = own, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(mine), written(changed)
                values += resemblance(mine, changed, k), resemblance(mine, theirs, k), distinct_shingles(mine, k), containment(mine, changed, k)
                for name, value in zip(names, values):
                    out[name].append(value)
            waiting[:] = [] if rows[-1][2] else rows[-1:]
            return out

        return kernel

    names = [id_column, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_shingles", "in_edited"]
    kinds = [dict(docs.dtypes)[id_column], "bigint", "string", "string", "string", "double", "double", "double", "double"]
    ddl = ", ".join(f"{n} {t}" for n, t in zip(names, kinds))
    return map_slices(_in_ranges(docs, id_column, text_column), make, ddl, 256)
