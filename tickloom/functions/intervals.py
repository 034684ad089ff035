"""Joins by time without a nested loop: as-of and band joins whose rows meet by stretches of time.

A condition on a range of times alone has no key to deal rows by. Here every row belongs to a stretch of time (and to the keys, if there
are any); rows of one stretch meet by an ordinary shuffle or hash join, and what crosses its borders is handed on: the last value before a
stretch for an as-of join, a second stretch for a band. A long series or a registry of any size so takes many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def asof_in_stretches(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, cols: Sequence[str], *, inclusive: bool = True, backfill: bool = False, stretch: str = "year") -> DataFrame:
    """Adds to each row of ``left`` the ``cols`` of the last row of ``right`` not after it (before it, unless ``inclusive``), with or without keys
    ``by``. With ``backfill`` rows before the first get the first. Rows without a time get nulls.

    Of right rows of one key and time, the one with the largest ``cols`` counts as the last.
    """
    value = F.struct(*cols)
    right = right.where(F.col(right_on).isNotNull()).select(*by, F.col(right_on).alias("_t"), value.alias("_v"), F.date_trunc(stretch, right_on).alias("_s"))
    rows = left.withColumns({"_t": F.col(left_on), "_s": F.date_trunc(stretch, left_on)})
    # a row for each stretch that occurs on either side, and what was last before it
    each = F.struct("_t", "_v")
    ends = right.groupBy(*by, "_s").agg(F.max(each)["_v"].alias("_last"), F.min(each)["_v"].alias("_first"))
    stretches = rows.select(*by, "_s").distinct().unionByName(ends, allowMissingColumns=True).groupBy(*by, "_s").agg(F.max("_last").alias("_last"), F.max("_first").alias("_first"))
    order = W.partitionBy(*by).orderBy("_s")
    before = F.last("_last", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1))
    first = F.first("_first", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    known = stretches.select(*[F.col(c).alias(f"_k_{c}") for c in by], F.col("_s").alias("_k_s"), before.alias("_before"), first.alias("_first"))
    side = 1 if inclusive else 0
    both = rows.withColumn("_side", F.lit(side)).unionByName(right.withColumn("_side", F.lit(1 - side)), allowMissingColumns=True)
    w = W.partitionBy(*by, "_s").orderBy("_t", "_side", F.asc_nulls_first("_v")).rowsBetween(W.unboundedPreceding, W.currentRow)
    met = both.withColumn("_here", F.last("_v", ignorenulls=True).over(w)).where(F.col("_side") == side)
    same = F.col("_s").eqNullSafe(F.col("_k_s"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    found = F.coalesce("_here", "_before", *(["_first"] if backfill else []))
    out = met.join(known, same, "left").withColumn("_found", F.when(F.col("_t").isNotNull(), found))
    return out.select(*left.columns, *[F.col("_found")[c].alias(c) for c in cols])


def near_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, days: int, how: str = "inner") -> DataFrame:
    """``left`` joined to the rows of ``right`` with equal ``by`` whose date is at most ``days`` from its own; ``how`` as of a Spark join.

    Stretches are as long as the band, so a right row lies in two of them at most and a left row in one: each pair meets once.
    """
    width = 2 * days + 1
    day = lambda c: F.datediff(F.col(c), F.lit("1970-01-01").cast("date"))
    place = lambda d: F.floor(d / width)
    rows = left.withColumn("_s", place(day(left_on)))
    near = right.where(F.col(right_on).isNotNull()).withColumn("_r", F.explode(F.array_distinct(F.array(place(day(right_on) - days), place(day(right_on) + days)))))
    near = near.select(F.col("_r"), F.col(right_on).alias("_right_on"), *[F.col(c).alias(f"_k_{c}") for c in by], *[c for c in right.columns if c not in by and c != right_on])
    cond = (F.col("_s") == F.col("_r")) & (F.abs(F.datediff(F.col(left_on), F.col("_right_on"))) <= days)
    for c in by:
        cond = cond & (F.col(c) == F.col(f"_k_{c}"))
    return rows.join(near, cond, how).drop("_s", "_r", *[f"_k_{c}" for c in by]).withColumnsRenamed({"_right_on": right_on if right_on not in left.columns else f"{right_on}_right"})
