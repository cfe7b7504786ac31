"""Numeric array functions as column expressions: all stay in the JVM."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double"))


def sign_hash(values: Column | str) -> Column:
    """64 values to as many bits: whether each exceeds the median of all; the first is the most significant."""
    values = F.transform(_col(values), lambda x: x.cast("double"))
    ordered = F.sort_array(values)
    median = (F.get(ordered, F.lit(31)) + F.get(ordered, F.lit(32))) / 2
    return F.aggregate(
        F.transform(values, lambda x: F.when(x > median, F.lit(1)).otherwise(0).cast("long")),
        F.lit(0).cast("long"),
        lambda a, b: F.shiftleft(a, 1).bitwiseOR(b),
    )


def hamming(a: Column | str, b: Column | str) -> Column:
    return F.bit_count(_col(a).bitwiseXOR(_col(b)))


def normalized(values: Column | str) -> Column:
    """Values over their Euclidean norm; zeros stay zeros."""
    values = _col(values)
    norm = F.sqrt(total(F.transform(values, lambda x: x.cast("double") * x.cast("double"))))
    return F.transform(values, lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0)))


def correlation(a: Column | str, b: Column | str) -> Column:
    """Pearson correlation of two arrays of one length; 1 if either is constant."""
    a, b = _col(a), _col(b)
    n = F.size(a)
    mean_a, mean_b = total(a) / n, total(b) / n
    both = total(F.zip_with(a, b, lambda x, y: (x - mean_a) * (y - mean_b)))
    own_a = total(F.transform(a, lambda x: (x - mean_a) * (x - mean_a)))
    own_b = total(F.transform(b, lambda x: (x - mean_b) * (x - mean_b)))
    return F.when(own_a * own_b > 0, both / F.sqrt(own_a * own_b)).otherwise(F.lit(1.0))


def softmax(values: Column | str) -> Column:
    values = _col(values)
    top = F.array_max(values)
    powers = F.transform(values, lambda x: F.exp((x - top).cast("double")))
    return F.transform(powers, lambda x: x / total(powers))


def laplacian_variance(values: Column | str, side: int) -> Column:
    """Population variance of the four-neighbour Laplacian of a square picture given row by row; borders mirror without repeating the edge.

    A kernel over Arrow batches: as nested array functions it is evaluated cell
    by cell. Null for null arrays, missing values and other sizes.
    """

    @F.pandas_udf("double")
    def kernel(rows: pd.Series) -> pd.Series:
        whole = [r is not None and len(r) == side * side for r in rows]
        out = np.full(len(rows), np.nan)
        if any(whole):
            grid = np.stack([r for r, fine in zip(rows, whole) if fine]).astype(float).reshape(-1, side, side)
            p = np.pad(grid, ((0, 0), (1, 1), (1, 1)), mode="reflect" if side > 1 else "edge")
            out[whole] = (p[:, :-2, 1:-1] + p[:, 2:, 1:-1] + p[:, 1:-1, :-2] + p[:, 1:-1, 2:] - 4 * grid).var(axis=(1, 2))
        return pd.Series(out).where(np.isfinite(out), None).astype("Float64")

    return kernel(_col(values))


def aspect_ratio(width: Column | str, height: Column | str) -> Column:
    """The longer side over the shorter."""
    width, height = _col(width), _col(height)
    return F.greatest(width, height) / F.least(width, height)


def ceil_div(a: Column | str, b: Column | str) -> Column:
    return F.ceil(_col(a) / _col(b)).cast("long")


def percent(part: Column | str, whole: Column | str) -> Column:
    """A share in percent; 0 of nothing."""
    return F.when(_col(whole) == 0, F.lit(0.0)).otherwise(_col(part) / _col(whole) * 100)
