"""Exact percentiles of large groups: the values at given ranks by successive histograms.

Spark's exact percentile holds all different values of a group in one task. Here a pass counts the values of each open interval in bins; the bin
that holds a rank is the next interval, and a few passes leave at most some thousand values in one, which are sorted. A pass shuffles a
count for each bin and task, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..scratch import durable, small

#: Bins of an interval in each pass; values that are sorted in one row, at most.
BINS, SORTED = 1_024, 16_384


def exact_percentiles(df: DataFrame, value: str, ps: Sequence[float], by: Sequence[str], bins: int = BINS, gather: int = SORTED) -> DataFrame:
    """``by, percentiles``: an array of the percentiles ``ps`` (0 to 1) of each group's values, linear between the two nearest ones, as
    ``percentile`` has them. Nulls and NaN don't count; groups without a value are left out, and so are null keys.

    ``df`` is read once for each pass (two or three, more if values lie very unevenly) and should be a written table.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    groups = durable(rows.groupBy(*by).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "groups")
    place = lambda p: F.lit(float(p)) * (F.col("n") - 1)
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(place(p)), F.ceil(place(p))) for p in ps])))
    # an interval for each rank: its ends, the values below it and in it
    state = groups.select(*by, F.explode(ranks).alias("k"), "lo", "hi", F.lit(0).cast("long").alias("below"), F.col("n").alias("inside"))
    done = None
    while True:
        state = durable(state, "intervals")
        wide = (F.col("inside") > gather) & (F.col("lo") < F.col("hi"))
        done = state.where(~wide) if done is None else done.unionByName(state.where(~wide))
        open_ = state.where(wide)
        if open_.isEmpty():
            break
        counted = _in_intervals(rows, open_, by).groupBy(*by, "lo", "hi", _bin(F.col("v"), F.col("lo"), F.col("hi"), bins).alias("bin")).agg(F.count("*").alias("c"), F.min("v").alias("first"), F.max("v").alias("last"))
        before = F.sum("c").over(W.partitionBy(*by, "lo", "hi").orderBy("bin").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("c")
        met = open_.join(counted.withColumn("before", before), [*by, "lo", "hi"]).where((F.col("k") - F.col("below") >= F.col("before")) & (F.col("k") - F.col("below") < F.col("before") + F.col("c")))
        state = met.select(*by, "k", F.col("first").alias("lo"), F.col("last").alias("hi"), (F.col("below") + F.col("before")).alias("below"), F.col("c").alias("inside"))
    done = durable(done, "intervals")
    narrow = done.where("lo < hi")
    values = _in_intervals(rows, narrow, by).groupBy(*by, "lo", "hi").agg(F.array_sort(F.collect_list("v")).alias("vs"))  # ``gather`` values at most
    at = narrow.join(values, [*by, "lo", "hi"]).select(*by, "k", F.get("vs", (F.col("k") - F.col("below")).cast("int")).alias("x")).unionByName(done.where("lo = hi").select(*by, "k", F.col("lo").alias("x")))
    found = at.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("k", "x"))).alias("at")).join(groups.select(*by, "n"), by)
    return found.select(*by, F.array(*[_between(F.col("at"), place(p)) for p in ps]).alias("percentiles"))


def _in_intervals(rows: DataFrame, state: DataFrame, by: Sequence[str]) -> DataFrame:
    """The rows of each different interval of ``state``; few intervals for each group, none of which overlap."""
    return rows.join(small(state.select(*by, "lo", "hi").distinct()), list(by)).where(F.col("v").between(F.col("lo"), F.col("hi")))


def _bin(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Never the same for the ends of an interval, so that every pass narrows it; an interval too wide for a double is cut at its ends."""
    width = hi - lo
    even = F.least(F.floor((v - lo) / width * bins), F.lit(bins - 1))
    return F.when(v == lo, 0).when(v == hi, bins - 1).when(width == float("inf"), 1).otherwise(even).cast("int")


def _between(at: Column, place: Column) -> Column:
    low, high = F.element_at(at, F.floor(place)), F.element_at(at, F.ceil(place))
    return F.when(low == high, low).otherwise(low + (high - low) * (place - F.floor(place)))
