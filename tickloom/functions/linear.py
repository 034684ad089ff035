"""Least squares from sums: Gram matrices of a series and its lags, elimination in columns, tail probabilities.

A regression on lags needs no more of a series than its sums of lagged products and the few values at its ends: sums that Spark adds up in
one pass with map-side combining. ``lag_sums`` takes them; ``lag_gram`` makes the Gram matrix of any number of lags and any first row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .core import ratio

#: Coefficients of Hart's rational approximation to the normal tail, highest power first, and where it ends.
NORMAL_TOP = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
NORMAL_BOTTOM = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)
NORMAL_NEAR, NORMAL_FAR = 7.07106781186547, 37.0


def polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    """Highest power first."""
    out = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        out = out * x + F.lit(float(c))
    return out


def normal_cdf(x: Column) -> Column:
    """The standard normal distribution function, to 1e-14; null for null."""
    a = F.abs(x)
    near = F.exp(-a * a / 2) * polynomial(a, NORMAL_TOP) / polynomial(a, NORMAL_BOTTOM)
    far = F.exp(-a * a / 2) / (a + 1 / (a + 2 / (a + 3 / (a + 4 / (a + 0.65))))) / 2.506628274631
    tail = F.when(a > NORMAL_FAR, 0.0).when(a < NORMAL_NEAR, near).when(x.isNotNull(), far)
    return F.when(x > 0, 1 - tail).otherwise(tail)


def interpolate(x: Column, points: Sequence[tuple[float, float]]) -> Column:
    """Piecewise linear through ``points`` (x ascending), constant beyond them; null for null."""
    out = F.when(x <= points[0][0], points[0][1])
    for (x0, y0), (x1, y1) in zip(points, points[1:]):
        out = out.when(x <= x1, y0 + (x - x0) * ((y1 - y0) / (x1 - x0)))
    return out.when(x.isNotNull(), points[-1][1])


def gram(*values: Column) -> Column:
    """The Gram matrix of ``values`` as an aggregate: sums of all products, row by row in one array. Each product is summed once."""
    sums = {(i, j): F.sum(values[i] * values[j]) for i in range(len(values)) for j in range(i, len(values))}
    return F.array(*[sums[min(i, j), max(i, j)] for i in range(len(values)) for j in range(len(values))])


def eliminate(matrix: Column, size: int, pivots: int) -> Column:
    """A square matrix, row by row in an array, after Gaussian elimination of the first ``pivots`` of its ``size`` rows, one after the other.

    Of a Gram matrix whose last row is the regressand, the last entry is then the sum of squared residuals; with the const alone
    eliminated it is the sum around the mean. Null where a pivot is 0.
    """
    places = F.sequence(F.lit(0), F.lit(size * size - 1))

    def step(m: Column, k: Column) -> Column:
        at = lambda i: F.get(m, i.cast("int"))
        row = lambda p: F.floor(p / size)
        return F.transform(places, lambda p: at(p) - ratio(at(row(p) * size + k) * at(k * size + p % size), F.nullif(at(k * size + k), F.lit(0.0))))

    return F.aggregate(F.sequence(F.lit(0), F.lit(pivots - 1)), matrix, step)


def lag_sums(df: DataFrame, value: str, lags: int, keys: Sequence[str], time: str) -> DataFrame:
    """``keys, n, total, products, head, tail``: of each series the number and sum of its values, the sums of products with the value k before
    for k from 0 to ``lags``, and the first and last ``lags`` values. One sort of the rows by key and time."""
    w = W.partitionBy(*keys).orderBy(time)
    x = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull()).select(*keys, x.alias("x"), F.row_number().over(w).alias("i"), F.count("*").over(W.partitionBy(*keys)).alias("n"), *[F.lag(x, k).over(w).alias(f"l{k}") for k in range(1, lags + 1)])
    ends = lambda near: F.transform(F.array_sort(F.collect_list(F.when(near, F.struct("i", "x")))), lambda s: s["x"])
    return rows.groupBy(*keys).agg(
        F.max("n").alias("n"), F.sum("x").alias("total"), F.array(F.sum(F.col("x") * F.col("x")), *[F.coalesce(F.sum(F.col("x") * F.col(f"l{k}")), F.lit(0.0)) for k in range(1, lags + 1)]).alias("products"),
        ends(F.col("i") <= lags).alias("head"), ends(F.col("i") > F.col("n") - lags).alias("tail"),
    )


def lag_gram(n: int, total: float, products: np.ndarray, head: np.ndarray, tail: np.ndarray, lags: int, first: int) -> np.ndarray:
    """The Gram matrix of (1, x_t, x_{t-1}, ..., x_{t-lags}) over the rows t > ``first`` (at least ``lags``, at most as many as ``head`` has).

    The sum over a shifted range is that over all rows without what the shift leaves out at both ends.
    """
    out = np.empty((lags + 2, lags + 2))
    out[0, 0] = n - first
    for i in range(lags + 1):
        out[0, i + 1] = out[i + 1, 0] = total - head[: first - i].sum() - (tail[-i:].sum() if i else 0.0)
        for j in range(i, lags + 1):
            k = j - i
            before = head[k : first - i] @ head[: max(first - i - k, 0)] if first - i > k else 0.0
            after = tail[len(tail) - i :] @ tail[len(tail) - i - k : len(tail) - k] if i else 0.0
            out[i + 1, j + 1] = out[j + 1, i + 1] = products[k] - before - after
    return out


def nested_residuals(matrix: np.ndarray) -> np.ndarray:
    """Sums of squared residuals of the last variable of a Gram matrix on its first 1, 2, ... variables, from one Cholesky factor."""
    scale = np.sqrt(np.maximum(np.diag(matrix), 1e-300))
    lower = np.linalg.cholesky(matrix / np.outer(scale, scale) + 1e-14 * np.eye(len(matrix)))
    return scale[-1] ** 2 * (1 - np.cumsum(lower[-1, :-1] ** 2))
