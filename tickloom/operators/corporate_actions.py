"""Splits, renames, dividends, share counts and the policy rate.

The registries are small; bars are joined to them by ticker and a date range, and factors multiply in one aggregate, so the order of
events does not matter and no bar is visited event by event.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.core import asof_join, keep_last
from ..schemas import PRICES

#: A jump matches a ratio if it is off by less than this factor.
JUMP = 2.5
#: Dividend yields that are taken for real, both ends excluded.
BAND = (0.0, 0.5)


def jump_matches(before: Column, after: Column, divisor: Column) -> Column:
    """Whether the price fell by about ``divisor``; false if either price is missing or not positive."""
    ok = (before > 0) & (after > 0) & (divisor > 0)
    return F.coalesce(F.when(ok, F.abs(F.ln((after / before) * divisor)) < math.log(JUMP)), F.lit(False))


def price_jumps(bars: DataFrame, events: DataFrame, price: str = "close") -> DataFrame:
    """``events`` (ticker, date, ratio, kind) with ``jump``: whether the last price before and the first from the date on match the ratio."""
    ev = events.withColumnsRenamed({"date": "event_date"})
    px = bars.where(F.col(price).isNotNull()).select("ticker", F.col("date").alias("d"), F.col(price).alias("p"))
    seen = ev.join(px, "ticker", "left").groupBy(*ev.columns).agg(
        F.max_by("p", F.when(F.col("d") < F.col("event_date"), F.col("d"))).alias("before"), F.min_by("p", F.when(F.col("d") >= F.col("event_date"), F.col("d"))).alias("after")
    )
    return seen.select(*ev.columns, jump_matches(F.col("before"), F.col("after"), F.col("ratio")).alias("jump")).withColumnRenamed("event_date", "date")


def factors_after(keys: DataFrame, events: DataFrame, on: str, value: str, name: str, *, inclusive: bool = False) -> DataFrame:
    """Adds to each row of ``keys`` (ticker, date) ``name``: the product of ``value`` over its ticker's events after the date (or on it); 1 without any.

    A ticker's events become intervals with the product of all events from their end on, so that a row meets one interval and not each
    event: the work grows with rows and events, not with their product.
    """
    per = events.groupBy(F.col("ticker").alias("_t"), F.col(on).alias("_on")).agg(F.product(value).alias("_v"))
    w = W.partitionBy("_t").orderBy("_on")
    later = per.select("_t", F.lag("_on").over(w).alias("_after"), "_on", F.product("_v").over(w.rowsBetween(W.currentRow, W.unboundedFollowing)).alias("_p"))
    since = F.col("_after").isNull() | (F.col("date") > F.col("_after") if inclusive else F.col("date") >= F.col("_after"))
    until = F.col("date") <= F.col("_on") if inclusive else F.col("date") < F.col("_on")
    met = keys.join(later, (F.col("ticker") == F.col("_t")) & since & until, "left")
    return met.withColumn(name, F.coalesce("_p", F.lit(1.0))).drop("_t", "_after", "_on", "_p")


def split_factors(bars: DataFrame, splits: DataFrame) -> DataFrame:
    """``bars`` with ``factor``: the product of the ratios of the splits after each bar. ``auto`` splits count if the raw closes show the jump."""
    active = price_jumps(bars, splits.where("kind in ('price', 'auto')")).where("kind = 'price' or jump")
    return factors_after(bars, active, "date", "ratio", "factor")


def adjust_for_splits(bars: DataFrame, splits: DataFrame) -> DataFrame:
    """Bars before a split in its terms: prices divided by the ratio, volume multiplied. ``shares`` splits and other columns are left alone.

    ``auto`` splits count if the raw closes show the jump.
    """
    out, factor = split_factors(bars, splits), F.col("factor")
    changes = {c: F.col(c) / factor for c in PRICES if c in bars.columns} | ({"volume": F.col("volume") * factor} if "volume" in bars.columns else {})
    return out.withColumns(changes).select(*bars.columns)


def rename_chains(renames: DataFrame) -> DataFrame:
    """``old, final, cutoff``: each old ticker's last name and the date from which its rows are void. Links are followed while dates do not
    go back. Each round doubles what is followed; a chain can't have more links than there are names, so their number bounds the rounds."""
    chain = renames.select("old", F.col("new").alias("final"), F.col("date").alias("cutoff"), F.col("date").alias("until"))
    for _ in range(max(renames.count(), 1).bit_length()):
        link = chain.select(F.col("old").alias("o"), F.col("final").alias("f"), F.col("cutoff").alias("c"), F.col("until").alias("u"))
        chain = chain.join(link, (F.col("final") == F.col("o")) & (F.col("c") >= F.col("until")), "left").select("old", F.coalesce("f", "final").alias("final"), "cutoff", F.coalesce("u", "until").alias("until"))
    return chain.select("old", "final", "cutoff")


def apply_renames(bars: DataFrame, renames: DataFrame) -> DataFrame:
    """Bars under their last names, with ``source_ticker``; rows of an old name from its change on are dropped."""
    chains = rename_chains(renames)
    out = bars.join(chains, bars["ticker"] == chains["old"], "left").where(F.col("cutoff").isNull() | (F.col("date") < F.col("cutoff")))
    return out.select(F.coalesce("final", "ticker").alias("ticker"), *[c for c in bars.columns if c != "ticker"], F.col("ticker").alias("source_ticker"))


def one_per_date(stitched: DataFrame) -> DataFrame:
    """Of several bars of one date that of the security which has the final name itself."""
    return keep_last(stitched, ["ticker", "date"], (F.col("source_ticker") == F.col("ticker")).desc(), F.desc("source_ticker"))


def dividend_factors(adjusted: DataFrame, dividends: DataFrame, *, inclusive: bool = True, band: tuple[float, float] | None = BAND) -> DataFrame:
    """``ticker, closing_date, factor``: 1 less the yield of each dividend on the last bar up to its date (before it, if not ``inclusive``).

    ``adjusted`` has ticker, date, the raw close and ``adj``, the split-adjusted one. The yield is taken on the raw close or, if that is
    outside the band, on the adjusted one; a dividend with neither is skipped. Without a band only a positive price is asked for.
    """
    base = asof_join(dividends, adjusted.select("ticker", "date", F.col("close").alias("raw"), "adj"), ["ticker"], "closing_date", "date", ["raw", "adj"], inclusive=inclusive)
    raw, adj = F.try_divide("dividend_value", "raw"), F.try_divide("dividend_value", "adj")
    if band is None:
        y = F.when(F.col("raw") > 0, raw)
    else:
        y = F.coalesce(*[F.when((x > band[0]) & (x < band[1]), x) for x in (raw, adj)])
    return base.select("ticker", "closing_date", (1 - y).alias("factor")).where("factor is not null")


def adjusted_close(bars: DataFrame, dividends: DataFrame, splits: DataFrame, *, inclusive: bool = True, band: tuple[float, float] | None = BAND) -> DataFrame:
    """Adds ``adj_close``: the split-adjusted close times the factors of all dividends from the bar's date on (after it, if not ``inclusive``)."""
    cols = [c for c in bars.columns if c != "adj_close"]
    adjusted = split_factors(bars.drop("adj_close"), splits).withColumn("adj", F.col("close") / F.col("factor"))
    factors = dividend_factors(adjusted, dividends, inclusive=inclusive, band=band)
    out = factors_after(adjusted, factors, "closing_date", "factor", "_div", inclusive=inclusive)
    return out.select(*cols, (F.col("adj") * F.col("_div")).alias("adj_close"))


def simple_adjusted_close(bars: DataFrame, dividends: DataFrame) -> DataFrame:
    """Adds ``adj_close`` by dividends alone: raw closes, bars before the date only, no band."""
    none = bars.sparkSession.createDataFrame([], "ticker string, date date, ratio double, kind string")
    return adjusted_close(bars, dividends, none, inclusive=False, band=None)


def adjusted_shares(bars: DataFrame, shares: DataFrame, splits: DataFrame) -> DataFrame:
    """Snapshots in the terms of the prices: those before a ``shares`` split divided by its ratio, before an ``auto`` one that prices don't show multiplied."""
    ev = price_jumps(bars, splits.where("kind in ('shares', 'auto')"))
    ev = ev.select("ticker", F.col("date").alias("event_date"), F.when(F.col("kind") == "shares", 1 / F.col("ratio")).when(~F.col("jump"), F.col("ratio")).alias("f")).where("f is not null")
    once = keep_last(shares, ["ticker", "date"], F.desc("shares"))
    return factors_after(once, ev, "event_date", "f", "_f").select("ticker", "date", (F.col("shares") * F.col("_f")).alias("shares"))


def market_cap(bars: DataFrame, shares: DataFrame, splits: DataFrame, price: str = "close") -> DataFrame:
    """Adds ``shares`` as of each bar (the first snapshot also before it) and ``market_cap``; null for tickers without snapshots."""
    own = adjusted_shares(bars, shares, splits)
    out = asof_join(bars.drop("shares"), own, ["ticker"], "date", "date", ["shares"], backfill=True)
    return out.withColumn("market_cap", F.col(price) * F.col("shares"))


def risk_free_monthly(dates: DataFrame, key_rate: DataFrame, date: str = "date") -> DataFrame:
    """Adds ``rf``: a month's share of the yearly percentage in force (before the first: the first); 0 if the registry is empty."""
    out = asof_join(dates, key_rate.withColumnRenamed("date", "_since"), [], date, "_since", ["rate"], backfill=True)
    return out.withColumn("rf", F.coalesce(F.col("rate") / 100 / 12, F.lit(0.0))).drop("rate")


def full_history(bars: DataFrame, renames: DataFrame, splits: DataFrame) -> DataFrame:
    """The whole history under final names: stitched, split-adjusted, one bar a date; ``adj_close`` is the close where it is not given."""
    out = one_per_date(adjust_for_splits(one_per_date(apply_renames(bars, renames)), splits))
    close = F.coalesce(F.col("adj_close"), F.col("close")) if "adj_close" in bars.columns else F.col("close")
    return out.withColumn("adj_close", close)


def trailing(df: DataFrame, days: int, date: str = "date") -> DataFrame:
    """Rows of the last ``days`` days that occur."""
    order = W.orderBy(F.desc(date))
    recent = df.select(date).distinct().withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= days).select(date)
    return df.join(F.broadcast(recent), date)
