"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import checkpointed


#: A vertex with more edges than this, and than leaves room for BROADCAST_HUBS of them, is a hub.
HOT, BROADCAST_HUBS = 20_000, 100_000
#: Edges that a task writes in each round, on average.
TASK_EDGES = 5_000


def _with_least(edges: DataFrame, most: int, own: bool) -> DataFrame:
    """The edges (a, b) with m, the least of a's b, and of a itself if ``own``. Of at most so many edges.

    Hubs are sent to the edges instead of their edges to one task; that there
    are no more than BROADCAST_HUBS follows from the number of edges.
    """
    least = edges.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("degree"))
    if own:
        least = least.withColumn("m", F.least("a", "m"))
    hot = max(HOT, most // BROADCAST_HUBS)
    if most <= hot:
        return edges.join(least.drop("degree"), "a")
    hubs = F.broadcast(least.where(F.col("degree") > hot).drop("degree"))
    others = edges.join(hubs.select("a"), "a", "left_anti").join(least.where(F.col("degree") <= hot).drop("degree"), "a")
    return others.union(edges.join(hubs, "a"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) of every vertex with an edge; component_id is its component's smallest id.

    Alternates large-star and small-star: each vertex hangs its larger, then its
    smaller neighbours on its least one, until every component is a star. That
    takes about log n rounds whatever the shape; every round is two aggregates
    and two equi-joins, cut off by a checkpoint, and nothing is collected but a
    count and a checksum of the edges. Loops and edges with nulls are ignored.
    """
    edges = checkpointed(
        edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") > F.col("b")))
        .distinct()
    )
    was = _state(edges)
    while was[0]:
        # large star: of each vertex, the larger neighbours go to its least neighbour or itself
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, 2 * was[0], True).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: of each vertex, the smaller neighbours and itself go to the least of them
        small = (
            _with_least(large, was[0], False)
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        # no more edges than before: so many tasks are enough, and as many files
        edges = checkpointed(small.coalesce(-(-was[0] // TASK_EDGES)))
        now = _state(edges)
        if now == was:
            break
        was = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct()
    )
