"""Exact top-k search by integer inner product with MaxScore.

A term is a dimension; its postings in a shard are the column of that
dimension. A query's terms are ordered by how much any document of the shard
can gain from them. The tail whose joint bound cannot lift a document over the
k-th best score so far is non-essential: essential postings are traversed for
all documents, the others probed only for documents that still can compete.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from sluice.llm.batches import schema_of
from sluice.llm.vectors import matrix
from sluice.session import checkpointed, ship, stored_one_by_one

SHARD_ROWS = 16_384
QUERY_ROWS = 32_768
#: Documents scored in full to start with, for a first k-th best score.
SEED_ROWS = 256
#: Essential postings between two looks at what is left.
STRIDE = 8
#: Beyond this size components are multiplied as Python's integers.
SMALL = 1 << 27


def quantize(column: pa.Array | pa.ChunkedArray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    values, whole = matrix(column)
    scaled = np.floor(values * scale)
    if np.abs(scaled).max(initial=0) < SMALL:
        return scaled.astype(np.int64), whole
    out = np.empty(scaled.shape, object)
    out.flat[:] = [int(v) if np.isfinite(v) else 0 for v in scaled.flat]
    return out, whole & np.isfinite(scaled).all(1)


class Shard:
    """Some rows as postings by dimension. Equal rows of one id count once."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        ids, rows = ids[order], rows[order]
        repeated = np.flatnonzero(ids[1:] == ids[:-1])
        if len(repeated):
            first = {(int(i), *r.tolist()): k for k, (i, r) in reversed(list(enumerate(zip(ids, rows))))}
            keep = np.sort(np.fromiter(first.values(), np.int64, len(first)))
            ids, rows = ids[keep], rows[keep]
        self.ids = ids
        self.single = len(ids) < 2 or bool((ids[1:] != ids[:-1]).all())
        self.postings = np.ascontiguousarray(rows.T)
        self.most, self.least = (rows.max(0), rows.min(0)) if len(rows) else (np.zeros(rows.shape[1], rows.dtype),) * 2

    def top(self, query: np.ndarray, own: int, k: int, floor: int | None = None) -> list[tuple[int, int]]:
        """(id, score) of the k best without the query's own id: by score, then by smaller id. With a floor, those below it may be left out."""
        width = min(len(query), len(self.postings))
        query = query[:width]
        gain = np.maximum(query * self.most[:width], query * self.least[:width])
        terms = np.argsort(-np.abs(query * (self.most[:width] - self.least[:width])), kind="stable")
        terms = terms[query[terms] != 0]
        rest = np.concatenate([np.cumsum(gain[terms][::-1])[::-1], [0]]) if len(terms) else np.zeros(1, query.dtype)
        if floor is not None and rest[0] < floor:
            return []
        fair = self.ids != own
        scores = np.zeros(len(self.ids), self.postings.dtype)
        seed = np.flatnonzero(fair)[:SEED_ROWS]
        if len(seed) >= k and self.single:
            first = np.sort(query @ self.postings[:width, seed])[-k]
            floor = first if floor is None else max(floor, first)
        # essential postings: until the terms left cannot lift a document that has nothing yet
        at, alive = 0, None
        while at < len(terms):
            for term in terms[at : at + STRIDE]:
                scores += query[term] * self.postings[term]
            at = min(at + STRIDE, len(terms))
            if floor is not None:
                alive = np.flatnonzero((scores + rest[at] >= floor) & fair)
                if 4 * len(alive) < len(fair):
                    break
        if alive is None:
            alive = np.flatnonzero(fair)
        # non-essential postings: probed for what still competes
        held = scores[alive]
        while at < len(terms):
            for term in terms[at : at + STRIDE]:
                held = held + query[term] * self.postings[term][alive]
            at = min(at + STRIDE, len(terms))
            keep = held + rest[at] >= floor
            alive, held = alive[keep], held[keep]
        best = np.lexsort((self.ids[alive], -held))
        return best_of([(int(self.ids[alive[i]]), int(held[i])) for i in (best[:k] if self.single else best)], k)


def best_of(hits: list[tuple[int, int]], k: int) -> list[tuple[int, int]]:
    """The k best of (id, score), each id by its best score."""
    found: dict[int, int] = {}
    for i, score in sorted(hits, key=lambda h: (-h[1], h[0])):
        if len(found) == k:
            break
        found.setdefault(i, score)
    return list(found.items())


def _block(table: pa.Table, id_column: str, vector_column: str, scale: int) -> tuple[np.ndarray, np.ndarray]:
    values, whole = quantize(table.column(vector_column), scale)
    return table.column(id_column).to_numpy()[whole], values[whole]


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The k best rows of ``vectors`` for each of ``queries``: (query_id, rank, id, score), rank from 1.

    Queries are dealt into blocks of a bounded size by hash, one job each. A
    block goes to all tasks, each of which reads its part of the table shard by
    shard where it lies, carries the k-th best score of every query on from
    shard to shard, and sends k rows a query on to the merge: the table itself is
    never shuffled or copied. A block's results are written before the next
    block is read, so the driver holds one block however many there are. Rows with a null id, a null vector, or null or non-finite components
    take no part; rows with one id count once, by their best score, and of
    queries with one id the least vector asks. Fewer than k candidates give as
    many rows; an empty side gives no rows. Short vectors count as filled up
    with zeros, sums beyond a long are cut to its ends.
    """
    ship(vectors.sparkSession)
    kind = dict(vectors.dtypes)[id_column]
    rows = vectors.where(F.col(id_column).isNotNull()).select(id_column, vector_column)
    asked = queries.where(F.col(id_column).isNotNull()).groupBy(id_column).agg(F.min(vector_column).alias(vector_column))
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    asked = checkpointed(asked.withColumn("block", F.pmod(F.xxhash64(id_column), F.lit(blocks))))
    ddl = f"query_id {kind}, found {kind}, score bigint"

    def against(names: np.ndarray, wanted: np.ndarray) -> DataFrame:
        def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best: list[list[tuple[int, int]]] = [[] for _ in names]
            held, several = [], 0

            def look() -> None:
                ids, values = _block(pa.Table.from_batches(held), id_column, vector_column, scale)
                shard = Shard(ids, values)
                for q, own in enumerate(names):
                    floor = best[q][-1][1] if len(best[q]) == k else None
                    hits = shard.top(wanted[q], own, k, floor)
                    if hits:
                        best[q] = best_of(best[q] + hits, k)

            for batch in source:
                for start in range(0, batch.num_rows, SHARD_ROWS):
                    held.append(batch.slice(start, SHARD_ROWS))
                    several += held[-1].num_rows
                    if several >= SHARD_ROWS:
                        look()
                        held, several = [], 0
            if held:
                look()
            edge = (1 << 63) - 1
            flat = [(int(names[q]), i, min(edge, max(-edge - 1, s))) for q, hits in enumerate(best) for i, s in hits]
            for start in range(0, len(flat), 100_000):
                a, b, c = zip(*flat[start : start + 100_000])
                like = held_kind
                yield pa.RecordBatch.from_arrays([pa.array(a, like), pa.array(b, like), pa.array(c, pa.int64())], names=["query_id", "found", "score"])

        held_kind = to_arrow_schema(schema_of(ddl)).field(0).type
        return rows.mapInArrow(run, ddl)

    def merged(hits: DataFrame) -> DataFrame:
        once = hits.groupBy("query_id", "found").agg(F.max("score").alias("score"))
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "found")
        return (
            once.withColumn("rank", F.row_number().over(order))
            .where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("found").alias(id_column), "score")
        )

    def waves() -> Iterator[DataFrame]:
        for block in range(blocks):
            names, wanted = _block(asked.where(F.col("block") == block).select(id_column, vector_column).toArrow(), id_column, vector_column, scale)
            if len(names):
                yield merged(against(names, wanted))

    found = stored_one_by_one(waves())
    return merged(vectors.sparkSession.createDataFrame([], ddl)) if found is None else found
