"""Places in an order, without a key in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluice.session import checkpointed

#: Rows that one task ranks, on average.
RANKED_ROWS = 200_000


def ranked(df: DataFrame, key: list[str], order: list[str], name: str = "rank", rows: int | None = None) -> DataFrame:
    """A rank from 0 among the rows of each key, in ``name``. Rows that agree in all of ``order`` come in any order.

    Rows are dealt by ranges of (key, order), so a key that holds a third of
    all rows spans as many tasks as it needs; a part's ranks follow those of the
    parts before it, whose sizes are counted. The ranges are fixed by a
    checkpoint. A table for one task is ranked by a plain window.
    """
    rows = df.count() if rows is None else rows
    parts = -(-rows // RANKED_ROWS)
    if parts <= 1:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order)).cast("long") - 1)
    dealt = checkpointed(df.repartitionByRange(parts, *key, *order).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy(*key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(*(F.col(k).alias(f"_{k}") for k in key), F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    own = F.row_number().over(Window.partitionBy(*key, "_part").orderBy(*order)).cast("long") - 1
    same = F.col("_part") == F.col("_of")
    for k in key:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return dealt.withColumn("_own", own).join(firsts, same).withColumn(name, F.col("_own") + F.col("_first")).select(*df.columns, name)


def running_max(df: DataFrame, key: list[str], rank: str, value: str, name: str = "most", rows: int | None = None) -> DataFrame:
    """The largest value of a key's rows up to each, by rank, in ``name``. Ranks are cut into stretches; each stretch carries on the largest value of those before it."""
    rows = df.count() if rows is None else rows
    upto = Window.partitionBy(*key).orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    if rows <= RANKED_ROWS:
        return df.withColumn(name, F.max(value).over(upto))
    cut = df.withColumn("_stretch", F.floor(F.col(rank) / RANKED_ROWS))
    most = cut.groupBy(*key, "_stretch").agg(F.max(value).alias("_most"))
    before = Window.partitionBy(*key).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = most.select(*(F.col(k).alias(f"_{k}") for k in key), F.col("_stretch").alias("_of"), F.max("_most").over(before).alias("_carried"))
    own = F.max(value).over(Window.partitionBy(*key, "_stretch").orderBy(rank).rowsBetween(Window.unboundedPreceding, 0))
    same = F.col("_stretch") == F.col("_of")
    for k in key:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return cut.withColumn("_own", own).join(carried, same).withColumn(name, F.greatest("_own", "_carried")).select(*df.columns, name)
