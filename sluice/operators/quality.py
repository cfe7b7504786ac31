"""Quality filters and validation: every decision is a column, nothing is deleted."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.arrays import aspect_ratio, softmax
from sluice.operators import order
from sluice.session import checkpointed

#: Fixed values.
MIN_WIDTH, MIN_HEIGHT = 480, 360
MAX_WIDTH, MAX_HEIGHT = 1920, 1080
SHARPNESS = 100.0
SIMILARITY = 0.25
#: Prompts that are sent to every task at once, and that one row of logits may have; blocks of them between checkpoints.
PROMPTS, WAVE = 10_000, 4
ANCHORS = ("flood", "disaster", "water damage", "emergency")


@dataclass(frozen=True)
class Thresholds:
    """Of the heuristic cascade; all bounds pass."""

    min_width: float = 200
    min_height: float = 200
    max_aspect: float = 4.0
    min_blue: float = 0.05
    max_blue: float = 0.95
    min_edges: float = 0.01


def large_enough(width: str = "width", height: str = "height", min_width: int = MIN_WIDTH, min_height: int = MIN_HEIGHT) -> Column:
    """Whether neither side is below its least; unknown sizes aren't."""
    return F.coalesce((F.col(width) >= min_width) & (F.col(height) >= min_height), F.lit(False))


def normalized_size(width: str = "width", height: str = "height", keep_aspect: bool = False) -> Column:
    """struct<width, height> after normalisation: what exceeds the largest size in either way becomes just that size."""
    over = (F.col(width) > MAX_WIDTH) | (F.col(height) > MAX_HEIGHT)
    if keep_aspect:
        scale = F.least(MAX_WIDTH / F.col(width), MAX_HEIGHT / F.col(height))
        new = F.struct(F.round(F.col(width) * scale).cast("int").alias("width"), F.round(F.col(height) * scale).cast("int").alias("height"))
    else:
        new = F.struct(F.lit(MAX_WIDTH).alias("width"), F.lit(MAX_HEIGHT).alias("height"))
    return F.when(over, new).otherwise(F.struct(F.col(width).cast("int").alias("width"), F.col(height).cast("int").alias("height")))


def sharp(variance: str = "lap_var", threshold: float | None = None, default: float = SHARPNESS) -> Column:
    """Whether the Laplacian's variance reaches the threshold; unknown isn't sharp; 0 and None mean the default."""
    return F.coalesce(F.col(variance) >= (threshold or default), F.lit(False))


def cascade(df: DataFrame, checks: Sequence[tuple[str, Column, dict[str, Column]]]) -> DataFrame:
    """Ordered checks (name, predicate, scores): failed_check is the first that isn't true, null if all are.

    A check's scores are null where an earlier one failed. Conditions are lazy
    in CASE, so a native check costs nothing where an earlier one has failed.
    """
    failed = None
    reached = F.lit(True)
    scores = []
    for name, passes, values in checks:
        passes = F.coalesce(passes, F.lit(False))
        scores += [F.when(reached, v).alias(k) for k, v in values.items()]
        failed = F.when(~passes, name) if failed is None else failed.when(~passes, name)
        reached = reached & passes
    last = failed if failed is not None else F.lit(None).cast("string")
    return df.select("*", *scores, last.alias("failed_check"))


def heuristics(df: DataFrame, t: Thresholds = Thresholds(), width: str = "width", height: str = "height", blue: str = "blue", edges: str = "edges") -> DataFrame:
    """Readable, size, shape, colour, edges: in that order, cheap ones first."""
    ratio = aspect_ratio(width, height)
    return cascade(
        df,
        [
            ("readable", F.col(width).isNotNull() & F.col(height).isNotNull() & (F.least(width, height) > 0), {}),
            ("size", (F.col(width) >= t.min_width) & (F.col(height) >= t.min_height), {}),
            ("aspect", ratio <= t.max_aspect, {"aspect_ratio": ratio}),
            ("blue", F.col(blue).between(t.min_blue, t.max_blue), {"blue_ratio": F.col(blue)}),
            ("edges", F.col(edges) >= t.min_edges, {"edge_density": F.col(edges)}),
        ],
    )


def similarity(df: DataFrame, logits: str = "logits", n_keywords: str = "n_keywords", threshold: float = SIMILARITY) -> DataFrame:
    """max_prob, avg_prob and similar, from one logit for each keyword and, after them, each anchor.

    All share the softmax's sum, only the keywords' are looked at. Without
    keywords a row passes, without logits it fails.
    """
    own = F.slice(softmax(logits), 1, F.col(n_keywords))
    best = F.array_max(own)
    mean = F.aggregate(own, F.lit(0.0), lambda a, x: a + x) / F.col(n_keywords)
    some = F.col(n_keywords) > 0
    passes = F.when(~some, F.lit(True)).otherwise(F.coalesce(best >= threshold, F.lit(False)))
    return df.select("*", F.when(some, best).alias("max_prob"), F.when(some, mean).alias("avg_prob"), passes.alias("similar"))


def similarity_logits(assets: DataFrame, prompts: DataFrame, asset_vector: str = "embedding", prompt_vector: str = "vector", prompt_order: str = "prompt_pos", scale: float = 100.0) -> DataFrame:
    """The assets with ``logits``: scaled inner products with each prompt, in the prompts' order.

    The prompts (a query's keywords and anchors) are packed into one row of one
    array, whose size is the number of prompts, so the assets aren't multiplied.
    Every asset's logits have that size as well: more than PROMPTS prompts are
    an error here and a case for ``similarity_of_many``, which has no such row.
    """
    if prompts.limit(PROMPTS + 1).count() > PROMPTS:
        raise ValueError(f"more than {PROMPTS} prompts for one set of logits")
    packed = prompts.agg(F.transform(F.array_sort(F.collect_list(F.struct(prompt_order, prompt_vector))), lambda p: p[prompt_vector]).alias("_prompts"))
    product = F.transform(
        "_prompts", lambda p: F.aggregate(F.zip_with(p, F.col(asset_vector), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda a, x: a + x) * scale
    )
    return assets.crossJoin(F.broadcast(packed)).select(*assets.columns, product.alias("logits"))


def similarity_of_many(assets: DataFrame, prompts: DataFrame, n_keywords: str = "n_keywords", asset_vector: str = "embedding", prompt_vector: str = "vector", prompt_order: str = "prompt_pos", scale: float = 100.0, threshold: float = SIMILARITY, block: int = PROMPTS) -> DataFrame:
    """What ``similarity`` says of ``similarity_logits``, for any number of prompts and without a row of logits.

    The prompts, in order, are keywords up to each asset's ``n_keywords`` and
    anchors from there on. They are taken in blocks of one broadcast row each;
    an asset carries from block to block the largest logit, the sum of
    exponentials less it, and the same of its keywords, which is all that a
    softmax needs of what came before. An asset without a vector, or any asset
    where there are keywords but no prompts, fails.
    """
    placed = checkpointed(order.ranked(prompts.select(F.col(prompt_order).alias("_order"), F.col(prompt_vector).alias("_vector")), [], ["_order"], "_place"))
    blocks = -(-placed.count() // block)
    state = F.struct(*(F.lit(x).alias(n) for n, x in (("most", float("-inf")), ("sum", 0.0), ("best", float("-inf")), ("own", 0.0))))
    found = assets.withColumn("_state", state)
    some = F.col(n_keywords) > 0
    for k in range(blocks):
        part = placed.where(F.floor(F.col("_place") / block) == k)
        packed = part.agg(F.collect_list(F.struct("_place", "_vector")).alias("_block"))

        def fold(now: Column, prompt: Column) -> Column:
            product = F.aggregate(F.zip_with(prompt["_vector"], F.col(asset_vector), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda a, x: a + x) * scale
            most = F.greatest(now["most"], product)
            shrunk, added = F.exp(now["most"] - most), F.exp(product - most)
            own = prompt["_place"] < F.col(n_keywords)
            return F.struct(
                most.alias("most"),
                (now["sum"] * shrunk + added).alias("sum"),
                F.when(own, F.greatest(now["best"], product)).otherwise(now["best"]).alias("best"),
                (now["own"] * shrunk + F.when(own, added).otherwise(0.0)).alias("own"),
            )

        found = found.crossJoin(F.broadcast(packed)).withColumn("_state", F.aggregate("_block", F.col("_state"), fold)).drop("_block")
        if k % WAVE == WAVE - 1:  # what was sent to the tasks can go
            found = checkpointed(found)
    sums = F.col("_state.sum") > 0
    best = F.when(sums, F.exp(F.col("_state.best") - F.col("_state.most")) / F.col("_state.sum"))
    mean = F.when(sums, F.col("_state.own") / F.col("_state.sum") / F.col(n_keywords))
    known = F.col(asset_vector).isNotNull()
    passes = F.when(~some, F.lit(True)).otherwise(F.coalesce(known & (best >= threshold), F.lit(False)))
    return found.select(*assets.columns, F.when(some & known, best).alias("max_prob"), F.when(some & known, mean).alias("avg_prob"), passes.alias("similar"))


def compose(df: DataFrame, verdicts: Sequence[tuple[str, str]]) -> DataFrame:
    """valid and rejected_by: (name, boolean column) verdicts in order, all of which must hold."""
    failed = None
    for name, column in verdicts:
        bad = ~F.coalesce(F.col(column), F.lit(False))
        failed = F.when(bad, name) if failed is None else failed.when(bad, name)
    rejected = failed if failed is not None else F.lit(None).cast("string")
    return df.select("*", rejected.alias("rejected_by")).withColumn("valid", F.col("rejected_by").isNull())
