"""Ranks within groups that are too large to be sorted in one task.

A window over a group sorts it in one task. Here equal values are counted first; the different values are dealt to bins of about equal size
by approximate quantiles, sorted bin by bin, and a bin's ranks begin behind the counts of the bins before. Only counts of bins meet in a
task for each group. Any quantiles give the same ranks if all parts of the plan deal by the same ones; an approximate quantile depends on
the order in which tasks' results arrive, so they are worked out once and written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..scratch import durable

#: Bins of a group.
BINS = 64


def _ranked_values(df: DataFrame, value: str, by: Sequence[str], bins: int) -> DataFrame:
    """``by, value, _c, _before, _n``: each different value of a group with its count, the number of rows with a smaller one and of all."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_c"))
    places = [i / bins for i in range(1, bins)]
    edges = counts.groupBy(*by).agg(F.percentile_approx(value, places, F.lit(100 * bins)).alias("_edges"))
    edges = durable(edges, "edges")
    bin_ = F.aggregate("_edges", F.lit(0), lambda n, e: n + (e < F.col(value)).cast("int"))
    binned = counts.join(edges, list(by)).withColumn("_bin", bin_).drop("_edges")
    sizes = binned.groupBy(*by, "_bin").agg(F.sum("_c").alias("_size"))
    order = W.partitionBy(*by).orderBy("_bin")
    starts = sizes.select(*by, "_bin", F.coalesce(F.sum("_size").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"), F.sum("_size").over(W.partitionBy(*by)).alias("_n"))
    within = W.partitionBy(*by, "_bin").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    run = F.sum("_c").over(within) - F.col("_c")
    return binned.withColumn("_run", run).join(starts, [*by, "_bin"]).select(*by, value, "_c", (F.col("_start") + F.col("_run")).alias("_before"), "_n")


def large_pct_ranks(df: DataFrame, value: str, by: Sequence[str], name: str, bins: int = BINS) -> DataFrame:
    """Adds ``name``: the rank within the group's non-null values as a share of their number, ties averaged, as ``pct_rank_avg``; null for
    null. Keys must not be null."""
    share = (F.col("_before") + (F.col("_c") + 1) / 2) / F.col("_n")
    found = _ranked_values(df, value, by, bins).select(*by, value, share.alias(name))
    return df.join(found, [*by, value], "left").select(*df.columns, name)


def large_top(df: DataFrame, value: str, by: Sequence[str], share: float | None = None, n: int | None = None, tie: Sequence[str] = ("ticker",), bins: int = BINS) -> DataFrame:
    """The rows with the highest values of each group: ``n`` of them, or floor(``share`` times its values), 1 at least; ties by ``tie``.

    Only the rows of the one value at the border, of which some belong and some don't, are sorted.
    """
    values = _ranked_values(df, value, by, bins)
    wanted: Column = F.lit(n) if n is not None else F.greatest(F.lit(1), F.floor(F.col("_n") * share))
    above = F.col("_n") - F.col("_before") - F.col("_c")  # rows with a larger value
    near = values.select(*by, value, above.alias("_above"), "_c", wanted.alias("_wanted")).where("_above < _wanted")
    rows = df.join(near, [*by, value])
    whole = rows.where(F.col("_above") + F.col("_c") <= F.col("_wanted"))
    border = rows.where(F.col("_above") + F.col("_c") > F.col("_wanted"))
    place = F.row_number().over(W.partitionBy(*by).orderBy(*tie))
    border = border.withColumn("_place", place).where(F.col("_place") <= F.col("_wanted") - F.col("_above"))
    return whole.select(*df.columns).unionByName(border.select(*df.columns))
