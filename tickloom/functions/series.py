"""Long series in pieces: row numbers, rolling statistics and linear recurrences without one task for a whole series.

A window over a key runs in one task for each key, which a few keys of millions of rows don't stand. Here rows are numbered by counting
them in stretches of time first; then blocks of consecutive rows, each with the rows before it that its first rows look at (its halo), are
the groups that windows run over. All of it is native; a series takes as many tasks as it has blocks.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

#: Rows of a block, at least; times the halo, at least.
BLOCK_ROWS, BLOCK_HALOS = 65_536, 4
#: What of a value may be lost after a recurrence has forgotten it, as a power of e: below a double's precision.
FORGOTTEN = 41.5


def numbered(df: DataFrame, by: Sequence[str], time: str, *then: str, chunk: str = "year") -> DataFrame:
    """Adds ``_i``, the place of each row in its series from 0, by ``time`` and the columns ``then``.

    Rows are counted by ``chunk``, a unit that ``date_trunc`` takes; a row's place is the number of rows in chunks before plus its place in
    its own. So a task sorts the rows of one chunk, and only counts of chunks meet.
    """
    own = df.withColumn("_chunk", F.date_trunc(chunk, time))
    counts = own.groupBy(*by, "_chunk").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*by).orderBy(F.asc_nulls_first("_chunk")).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"_{c}") for c in by], F.col("_chunk").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    same = F.col("_chunk").eqNullSafe(F.col("_at"))
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    here = W.partitionBy(*by, "_chunk").orderBy(time, *then)
    found = own.join(offsets, same).withColumn("_i", F.col("_offset") + F.row_number().over(here) - 1)
    return found.drop("_chunk", "_at", "_offset", *[f"_{c}" for c in by])


def in_blocks(rows: DataFrame, by: Sequence[str], halo: int, block: int | None = None) -> DataFrame:
    """Numbered ``rows`` dealt by ``by`` and ``_block``; the last ``halo`` rows of a block come again in the next, with ``_own`` false.

    A block has at least as many rows as a halo, so no row comes more than twice.
    """
    size = max(block or max(BLOCK_ROWS, BLOCK_HALOS * halo), halo, 1)
    at = F.floor(F.col("_i") / size)
    again = F.when(F.col("_i") % size >= size - halo, F.array(F.struct(at.alias("b"), F.lit(True).alias("own")), F.struct((at + 1).alias("b"), F.lit(False).alias("own"))))
    copies = F.explode(F.coalesce(again, F.array(F.struct(at.alias("b"), F.lit(True).alias("own")))))
    return rows.withColumn("_copy", copies).withColumns({"_block": F.col("_copy.b"), "_own": F.col("_copy.own")}).drop("_copy").repartition(*by, "_block")


def rolling_blocks(df: DataFrame, columns: dict[str, Callable[[WindowSpec], Column]], halo: int, by: Sequence[str] = ("ticker",), time: str = "date", then: Sequence[str] = (), chunk: str = "year", block: int | None = None) -> DataFrame:
    """``df`` with ``columns``, each made from a window in the order of ``time`` (and ``then``); a column may use those before it, and together
    they look at most ``halo`` rows back. The result is that of the same columns over windows of whole series.
    """
    rows = in_blocks(numbered(df, by, time, *then, chunk=chunk), by, halo, block)
    w = W.partitionBy(*by, "_block").orderBy("_i")
    for name, made in columns.items():
        rows = rows.withColumn(name, made(w))
    return rows.where("_own").select(*dict.fromkeys([*df.columns, *columns]))


def rolling_columns(df: DataFrame, columns: dict[str, Callable[[WindowSpec], Column]], halo: int, split: str | None = None, by: Sequence[str] = ("ticker",), time: str = "date") -> DataFrame:
    """``rolling_blocks`` for series that are too long for a task each, cut by ``split``, a unit of time; without it, windows of whole series,
    which take one shuffle less."""
    if split:
        return rolling_blocks(df, columns, halo, by, time, chunk=split)
    for name, made in columns.items():
        df = df.withColumn(name, made(W.partitionBy(*by).orderBy(time)))
    return df


def forgets_after(factor: float) -> int:
    """Rows after which a recurrence with this factor has forgotten a value, to a double's precision."""
    return 1 if factor <= 0 else math.ceil(FORGOTTEN / -math.log(factor))


def recurrences(df: DataFrame, columns: dict[str, tuple[Callable[[WindowSpec], Column], float]], by: Sequence[str] = ("ticker",), time: str = "date", then: Sequence[str] = (), chunk: str | None = None, block: int | None = None, look_back: int = 0) -> DataFrame:
    """``df`` with ``columns``: y_t = factor y_{t-1} + input_t from y_{-1} = 0, for a factor from 0 to below 1; name: (input, factor).

    An input is made from a window of the series, looking at most ``look_back`` rows back, in which ``_i`` is a row's place. Two stretches of
    a recurrence combine to one: the second's own sum, and the first's times the factor to the second's length. Stretches are as long as the
    factor's memory, so that a row needs its own stretch, a running sum of inputs that are weighted by powers of the factor, and the end of
    the one before; what lies further back is below a double's precision. ``chunk`` cuts series that are too long for a task each into
    blocks; without it a series is one block, which takes one shuffle.
    """
    stretch = {name: forgets_after(factor) for name, (_, factor) in columns.items()}
    if chunk:
        rows = in_blocks(numbered(df, by, time, *then, chunk=chunk), by, 2 * max(stretch.values(), default=1) + look_back, block)
    else:
        rows = df.withColumn("_i", F.row_number().over(W.partitionBy(*by).orderBy(time, *then)) - 1).withColumns({"_block": F.lit(0), "_own": F.lit(True)})
    w = W.partitionBy(*by, "_block").orderBy("_i")
    so_far = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows = rows.select("*", *[made(w).alias(f"_u_{name}") for name, (made, _) in columns.items()])
    for name, (_, factor) in columns.items():
        if factor <= 0:
            rows = rows.withColumn(name, F.col(f"_u_{name}"))
            continue
        place, log = F.col("_i") % stretch[name], math.log(factor)
        power = lambda k, log=log: F.exp(k * F.lit(log))
        within = W.partitionBy(*by, "_block", F.floor(F.col("_i") / stretch[name])).orderBy("_i").rowsBetween(W.unboundedPreceding, W.currentRow)
        rows = rows.withColumn("_own_part", F.sum(F.col(f"_u_{name}") * power(-place)).over(within) * power(place))
        end = F.last(F.when(place == stretch[name] - 1, F.col("_own_part")), ignorenulls=True).over(so_far.rowsBetween(W.unboundedPreceding, -1))
        rows = rows.withColumn(name, F.col("_own_part") + F.coalesce(end, F.lit(0.0)) * power(place + 1)).drop("_own_part")
    return rows.where("_own").select(*df.columns, *columns)


def ewma(df: DataFrame, value: str, spans: Sequence[int], by: str = "ticker", time: str = "date", then: Sequence[str] = (), chunk: str | None = None, block: int | None = None) -> DataFrame:
    """Adds ``ewma_<span>`` (adjust=False, nulls skipped) to each row with a value, in time order; null where there is none. ``chunk`` as in
    ``recurrences``."""

    def weighted(span: int) -> Callable[[WindowSpec], Column]:
        return lambda _: F.col(value).cast("double") * F.when(F.col("_i") == 0, 1.0).otherwise(2.0 / (span + 1))

    have, columns = F.col(value).isNotNull(), {f"ewma_{s}": (weighted(s), 1 - 2.0 / (s + 1)) for s in spans}
    if not chunk:  # rows without a value come behind all others, where nothing looks back at them
        out = recurrences(df.withColumn("_last", ~have), columns, [by], "_last", [time, *then])
        return out.select(*df.columns, *[F.when(have, F.col(c)).alias(c) for c in columns])
    return recurrences(df.where(have), columns, [by], time, then, chunk, block).unionByName(df.where(~have), allowMissingColumns=True)
