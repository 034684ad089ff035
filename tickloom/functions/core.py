"""Building blocks: as-of joins, dense panels, rolling statistics, ranks, moments."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or either is null."""
    return F.try_divide(a, b)


def keep_last(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row for each key: the first in ``order``, which should be total."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, cols: Sequence[str], *, inclusive: bool = True, backfill: bool = False) -> DataFrame:
    """Adds to each row of ``left`` the ``cols`` of the last row of ``right`` not after it (before it, unless ``inclusive``).

    ``right`` becomes validity intervals by one window over its keys, and the join is an equi-join on ``by`` with a range condition.
    ``backfill`` opens the first interval to the past. Without ``by`` rows meet by stretches of time.
    """
    if not by:
        from .intervals import asof_in_stretches

        return asof_in_stretches(left, right, by, left_on, right_on, cols, inclusive=inclusive, backfill=backfill)
    order = W.partitionBy(*[F.col(c) for c in by]).orderBy(right_on)
    iv = right.select(*[F.col(c).alias(f"_{c}") for c in by], F.col(right_on).alias("_from"), F.lead(right_on).over(order).alias("_to"), F.row_number().over(order).alias("_first"), *cols)
    since = F.col(left_on) >= F.col("_from") if inclusive else F.col(left_on) > F.col("_from")
    until = F.col(left_on) < F.col("_to") if inclusive else F.col(left_on) <= F.col("_to")
    cond = ((since | (F.col("_first") == 1)) if backfill else since) & (until | F.col("_to").isNull())
    for c in by:
        cond = cond & (F.col(c) == F.col(f"_{c}"))
    return left.join(iv, cond, "left").drop("_from", "_to", "_first", *[f"_{c}" for c in by])


def asof_by_union(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, cols: Sequence[str]) -> DataFrame:
    """As ``asof_join`` (inclusive, no backfill) for two large sides: one shuffle of their union and a running last value."""
    tag = lambda df, on, side: df.withColumn("_t", F.col(on)).withColumn("_side", F.lit(side))
    both = tag(left, left_on, 1).unionByName(tag(right.select(*by, F.col(right_on).alias("_at"), F.struct(*cols).alias("_v")), "_at", 0).drop("_at"), allowMissingColumns=True)
    w = W.partitionBy(*by).orderBy("_t", "_side").rowsBetween(W.unboundedPreceding, W.currentRow)
    return both.withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_side = 1").select(*left.columns, *[F.col("_v")[c].alias(c) for c in cols])


def dense_grid(df: DataFrame, by: str = "ticker", time: str = "date") -> DataFrame:
    """``by, time, ord`` and the columns of ``df`` on the grid of all keys and all times that occur; ``ord`` counts the times from 1.

    The calendar is one row for each trading day or month, thousands at most, so every key gets it as an array and explodes it.
    """
    days = df.select(time).distinct().agg(F.array_sort(F.collect_list(time)).alias("_days"))
    keys = df.select(by).distinct().join(F.broadcast(days))
    grid = keys.select(by, F.posexplode("_days").alias("_o", time)).select(by, time, (F.col("_o") + 1).alias("ord"))
    return grid.join(df, [by, time], "left")


def rolling(fn: Callable[[str], Column], value: str, n: int, window: WindowSpec, least: int | None = None) -> Column:
    """``fn(value)`` over the last ``n`` rows, null unless ``least`` (default: all ``n``) of them have a value."""
    w = window.rowsBetween(-(n - 1), W.currentRow)
    return F.when(F.count(value).over(w) >= F.lit(n if least is None else least), fn(value).over(w))


def pct_rank_avg(value: Column, *partition: str) -> Column:
    """Rank within the partition's non-null values as a share of their number, ties averaged; null for null."""
    w = W.partitionBy(*partition)
    tied = F.count(value).over(W.partitionBy(*partition, value))
    return F.when(value.isNotNull(), (F.rank().over(w.orderBy(value.asc_nulls_last())) + (tied - 1) / 2) / F.count(value).over(w))


def skew_adjusted(value: Column) -> Column:
    """Bias-corrected skewness of an aggregate; null below 3 values."""
    n = F.count(value).cast("double")
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2))


def kurtosis_adjusted(value: Column) -> Column:
    """Bias-corrected excess kurtosis of an aggregate; null below 4 values."""
    n = F.count(value).cast("double")
    return F.when(n > 3, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(value) + 6))


def ewma_last(value: Column, time: Column, span: int) -> Column:
    """The last exponentially weighted mean of a group, as an aggregate."""
    a = 2.0 / (span + 1)
    xs = F.transform(F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(time.alias("t"), value.alias("v"))))), lambda s: s["v"])
    return F.aggregate(F.slice(xs, 2, F.greatest(F.size(xs) - 1, F.lit(0))), F.try_element_at(xs, F.lit(1)), lambda acc, x: acc * (1 - a) + x * a)


def top_and_bottom(df: DataFrame, value: Column, n: int, *tie: str) -> DataFrame:
    """The ``n`` first and last rows by ``value``, each once."""
    ties = [F.col(t) for t in tie]
    up = df.orderBy(value.desc_nulls_last(), *ties).limit(n)
    down = df.orderBy(value.asc_nulls_last(), *ties).limit(n)
    return up.unionByName(down).distinct()


def drawdown(equity: Column, window: WindowSpec) -> Column:
    """Equity over its running maximum, less 1."""
    return equity / F.max(equity).over(window.rowsBetween(W.unboundedPreceding, W.currentRow)) - 1


def growth(ret: Column, window: WindowSpec) -> Column:
    """Running product of 1 + ret."""
    return F.product(1 + ret).over(window.rowsBetween(W.unboundedPreceding, W.currentRow))


def first_value(value: Column, window: WindowSpec) -> Column:
    return F.first(value, ignorenulls=True).over(window.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))


def fill(value: Column, window: WindowSpec) -> Column:
    """Forward fill, then backward fill."""
    return F.coalesce(F.last(value, ignorenulls=True).over(window.rowsBetween(W.unboundedPreceding, W.currentRow)), F.first(value, ignorenulls=True).over(window.rowsBetween(W.currentRow, W.unboundedFollowing)))


def chi2_sf_even(x: Column, df: int) -> Column:
    """Upper tail of chi-square with an even number of degrees of freedom: exp(-x/2) times a finite sum."""
    half, term, total = x / 2, F.lit(1.0), F.lit(1.0)
    for k in range(1, df // 2):
        term = term * half / k
        total = total + term
    return F.exp(-half) * total
