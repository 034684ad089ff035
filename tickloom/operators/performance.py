"""Market overview: period performance, risk, breadth, sectors, unusual activity, structure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.core import drawdown, ewma_last, fill, keep_last, ratio, rolling
from ..functions.core import dense_grid as grid
from ..schemas import DAYS, YEAR_DAYS

#: Trailing periods by code, as SQL intervals back from the last date of the data.
PERIODS = {"1w": "7 days", "2w": "14 days", "1m": "1 month", "3m": "3 months", "6m": "6 months", "1y": "1 year", "3y": "3 years", "5y": "5 years", "10y": "10 years"}
#: Returns that risk figures need; the share of the extreme that counts as near it; the base turnover below which activity isn't judged.
LEAST_RETURNS, NEAR_HIGH, NEAR_LOW, BASE_TURNOVER = 60, 0.98, 1.02, 1e7


def by_date() -> WindowSpec:
    """A ticker's rows in the order of dates."""
    return W.partitionBy("ticker").orderBy("date")


def period_bounds(bars: DataFrame, code: str) -> DataFrame:
    """``start, end`` of a trailing period, one row: ``1d`` (the last two dates), ``ytd``, ``all``, ``since-YYYY`` or a code of PERIODS."""
    if code == "1d":
        return bars.select("date").distinct().orderBy(F.desc("date")).limit(2).agg(F.min("date").alias("start"), F.max("date").alias("end"))
    end = F.max("date")
    if code == "ytd":
        start = F.make_date(F.year(end), F.lit(1), F.lit(1))
    elif code == "all":
        start = F.min("date")
    elif code.startswith("since-"):
        start = F.lit(f"{code[6:]}-01-01").cast("date")
    else:
        start = F.to_date(end - F.expr(f"INTERVAL {PERIODS[code]}"))
    return bars.agg(start.alias("start"), end.alias("end"))


def within(bars: DataFrame, code: str) -> DataFrame:
    """The bars of a trailing period, both ends included."""
    bounds = period_bounds(bars, code)
    return bars.join(F.broadcast(bounds), F.col("date").between(F.col("start"), F.col("end"))).drop("start", "end")  # one row


def period_performance(bars: DataFrame, code: str = "1m", start: str | None = None, end: str | None = None) -> DataFrame:
    """First and last bar of each ticker in a period, with price and cap changes. Two bars and a positive first price are needed; a null
    price at either end leaves the ticker out. An explicit ``start``/``end`` replaces the trailing period."""
    own = bars.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date"))) if start else within(bars, code)
    cap = F.col("market_cap") if "market_cap" in bars.columns else F.lit(None).cast("double")
    ends = own.groupBy("ticker").agg(
        F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.min_by("close", "date").alias("first_price"), F.max_by("close", "date").alias("last_price"), F.min_by(cap, "date").alias("first_cap"), F.max_by(cap, "date").alias("last_cap")
    )
    return ends.where("n >= 2 and first_price > 0 and last_price is not null").select(
        "ticker", "first_date", "last_date", "first_price", "last_price", ((F.col("last_price") / F.col("first_price") - 1) * 100).alias("price_pct"), "first_cap", "last_cap",
        (ratio(F.col("last_cap"), F.nullif(F.col("first_cap"), F.lit(0.0))) * 100 - 100).alias("cap_pct"), (F.col("last_cap") - F.col("first_cap")).alias("cap_change"),
    )


def dense_closes(bars: DataFrame, price: str = "close") -> DataFrame:
    """``ticker, date, ord, px`` on the grid of all tickers and dates: a missing bar is a null, as in a table of dates by tickers."""
    return grid(bars.select("ticker", "date", F.col(price).alias("px")))


def with_returns(panel: DataFrame, price: str = "px", lag: int = 1, log: bool = False, pad: bool = False) -> DataFrame:
    """Adds ``ret`` against the row ``lag`` rows before; ``pad`` fills gaps forward first."""
    px = F.last(price, ignorenulls=True).over(by_date().rowsBetween(W.unboundedPreceding, W.currentRow)) if pad else F.col(price)
    panel = panel.withColumn("_px", px)
    gross = ratio(F.col("_px"), F.lag("_px", lag).over(by_date()))
    return panel.withColumn("ret", F.ln(gross) if log else gross - 1).drop("_px")


def risk_table(bars: DataFrame, index_bars: DataFrame, code: str = "1y", pad: bool = False) -> DataFrame:
    """Volatility, deepest drawdown, distance from the high of the period and beta to the index, in percent, for each ticker.

    Volatility and beta need 60 returns. Beta divides the covariance over common dates by the index's variance over all its dates.
    """
    panel = with_returns(dense_closes(within(bars, code)), pad=pad)
    idx = index_bars.select("date", (ratio(F.col("close"), F.lag("close").over(W.orderBy("date"))) - 1).alias("idx"))
    days = panel.select("date").distinct()
    idx = idx.join(days, "date", "left_semi")
    var = idx.agg(F.var_samp("idx").alias("idx_var"))
    filled = panel.withColumn("fpx", F.last("px", ignorenulls=True).over(by_date().rowsBetween(W.unboundedPreceding, W.currentRow)))
    filled = filled.withColumn("dd", drawdown(F.col("fpx"), by_date())).join(F.broadcast(idx), "date", "left")  # an index has one row a day
    out = filled.groupBy("ticker").agg(
        F.count("ret").alias("n"), (F.stddev_samp("ret") * DAYS**0.5 * 100).alias("vol"), (F.min("dd") * 100).alias("max_drawdown"),
        ((F.max_by("fpx", "date") / F.max("px") - 1) * 100).alias("from_high"), F.covar_samp("ret", "idx").alias("cov"),
    ).join(F.broadcast(var))
    enough = F.col("n") >= LEAST_RETURNS
    return out.select("ticker", "n", F.when(enough, F.col("vol")).alias("vol"), "max_drawdown", "from_high", F.when(enough, ratio(F.col("cov"), F.col("idx_var"))).alias("beta"))


def index_return(index_bars: DataFrame, code: str = "1m") -> DataFrame:
    """``index_pct`` of a period and whether the fast exponential mean is above the slow one over the whole history; one row."""
    own = within(index_bars, code).agg(((F.max_by("close", "date") / F.min_by("close", "date") - 1) * 100).alias("index_pct"))
    trend = index_bars.agg(ewma_last(F.col("close"), F.col("date"), 16).alias("fast"), ewma_last(F.col("close"), F.col("date"), 64).alias("slow"))
    return own.join(trend).withColumn("up_trend", F.col("fast") > F.col("slow"))


def enrich(perf: DataFrame, risk: DataFrame, index_pct: DataFrame) -> DataFrame:
    """Performance with risk: the move in standard deviations of the period's length, and alpha against beta times the index."""
    years = F.greatest(F.datediff("last_date", "first_date"), F.lit(1)) / YEAR_DAYS
    out = perf.join(risk.drop("n"), "ticker", "left").join(F.broadcast(index_pct.select("index_pct")))  # one row
    return out.withColumn("sigma_move", ratio(F.col("price_pct"), F.nullif(F.col("vol") * F.sqrt(years), F.lit(0.0)))).withColumn("alpha", F.col("price_pct") - F.col("beta") * F.col("index_pct")).drop("index_pct")


def filter_and_sort(perf: DataFrame, min_cap: float | None = None, sort_by: str = "price_pct") -> DataFrame:
    """Tickers of at least ``min_cap`` or unknown cap. Sorted down by a figure, up by ticker."""
    kept = perf if min_cap is None else perf.where(F.col("last_cap").isNull() | (F.col("last_cap") >= min_cap))
    return kept.orderBy(F.col("ticker") if sort_by == "ticker" else F.col(sort_by).desc_nulls_last(), F.col("ticker"))


def performance_display(perf: DataFrame) -> DataFrame:
    """Rounded figures, caps in billions, dates as day.month.year."""
    date = lambda c: F.date_format(c, "dd.MM.yyyy").alias(c)
    return perf.select("ticker", date("first_date"), date("last_date"), F.round("price_pct", 2).alias("price_pct"), F.round(F.col("last_cap") / 1e9, 2).alias("cap_bn"), F.round(F.col("cap_change") / 1e9, 2).alias("cap_change_bn"))


def market_summary(perf: DataFrame) -> DataFrame:
    """Counts up and down, median and cap-weighted change, total cap, the five best and worst; one row."""
    both = F.col("first_cap").isNotNull() & F.col("last_cap").isNotNull()
    start, end = F.sum(F.when(both, F.col("first_cap"))), F.sum(F.when(both, F.col("last_cap")))
    ranked = perf.withColumn("up_rank", F.row_number().over(W.orderBy(F.desc("price_pct"), "ticker"))).withColumn("down_rank", F.row_number().over(W.orderBy("price_pct", "ticker")))
    names = lambda rank: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(rank) <= 5, F.struct(rank, "ticker")))), lambda s: s["ticker"]), ", ")
    return ranked.agg(
        F.count("*").alias("n"), F.count_if(F.col("price_pct") > 0).alias("n_up"), F.count_if(F.col("price_pct") < 0).alias("n_down"), F.median("price_pct").alias("median_pct"),
        (ratio(end, start) * 100 - 100).alias("weighted_pct"), F.sum("last_cap").alias("total_cap"), (end - start).alias("cap_change"), names("up_rank").alias("best"), names("down_rank").alias("worst"),
    )


def marimekko(perf: DataFrame) -> DataFrame:
    """Bars of a width in proportion to cap, best first: share, right edge and centre in percent."""
    share = 100 * F.col("last_cap") / F.sum("last_cap").over(W.partitionBy())
    known = perf.where("last_cap is not null and price_pct is not null").withColumn("share", share)
    edge = F.sum("share").over(W.orderBy(F.desc("price_pct"), "ticker").rowsBetween(W.unboundedPreceding, W.currentRow))
    return known.select("ticker", "price_pct", "share", edge.alias("right"), (edge - F.col("share") / 2).alias("centre"))


def breadth(bars: DataFrame) -> DataFrame:
    """By date the share of tickers above their 50- and 200-day means (of those with price and mean), on the dense grid."""
    panel = dense_closes(bars)
    for n in (50, 200):
        panel = panel.withColumn(f"ma{n}", rolling(F.avg, "px", n, by_date()))
    share = lambda n: (100 * F.avg(F.when(F.col("px").isNotNull() & F.col(f"ma{n}").isNotNull(), (F.col("px") > F.col(f"ma{n}")).cast("int")))).alias(f"above_ma{n}")
    return panel.groupBy("date").agg(share(50), share(200))


def breadth_now(bars: DataFrame) -> DataFrame:
    """The last known shares, and who is near the high or low of the last year; one row."""
    by_date = breadth(bars)
    last = by_date.agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("date"))).alias(c) for c in ("above_ma50", "above_ma200")])
    ends = within(bars, "1y").where("close is not null").groupBy("ticker").agg(F.max("close").alias("high"), F.min("close").alias("low"), F.max_by("close", "date").alias("last"))
    near_high, near_low = F.col("last") >= NEAR_HIGH * F.col("high"), F.col("last") <= NEAR_LOW * F.col("low")
    names = lambda cond: F.array_join(F.slice(F.array_sort(F.collect_list(F.when(cond, F.col("ticker")))), 1, 10), ", ")
    return last.join(ends.agg(F.count_if(near_high).alias("n_near_high"), F.count_if(near_low).alias("n_near_low"), names(near_high).alias("near_high"), names(near_low).alias("near_low")))


def year_extremes(bars: DataFrame) -> DataFrame:
    """Adds the running high and low of the last calendar year to each bar."""
    frame = "over (partition by ticker order by date range between interval 1 year preceding and current row)"
    return bars.withColumn("high_1y", F.expr(f"max(close) {frame}")).withColumn("low_1y", F.expr(f"min(close) {frame}"))


def with_sector(df: DataFrame, sectors: DataFrame) -> DataFrame:
    """Adds ``sector``, ``other`` where unknown; the sector map is a registry."""
    return df.join(sectors, "ticker", "left").withColumn("sector", F.coalesce("sector", F.lit("other")))


def sector_performance(perf: DataFrame, sectors: DataFrame, members: int = 5) -> DataFrame:
    """Cap-weighted change of each sector over tickers with both caps; without any, the median price change. With count and first members."""
    both = F.col("first_cap").isNotNull() & F.col("last_cap").isNotNull()
    weighted = ratio(F.sum(F.when(both, F.col("last_cap"))), F.nullif(F.sum(F.when(both, F.col("first_cap"))), F.lit(0.0))) * 100 - 100
    return with_sector(perf, sectors).groupBy("sector").agg(
        F.count("*").alias("n"), F.coalesce(weighted, F.median("price_pct")).alias("pct"), F.sum("last_cap").alias("cap"), F.array_join(F.slice(F.array_sort(F.collect_list("ticker")), 1, members), ", ").alias("members")
    )


def market_map(perf: DataFrame, sectors: DataFrame) -> DataFrame:
    """Market, sector and ticker totals with cap-weighted performance, and the colour scale: the 95th percentile of absolute changes."""
    known = with_sector(perf, sectors).where("last_cap > 0 and price_pct is not null")
    rows = known.rollup("sector", "ticker").agg(F.sum("last_cap").alias("cap"), (F.sum(F.col("price_pct") * F.col("last_cap")) / F.sum("last_cap")).alias("pct"))
    scale = known.agg(F.percentile(F.abs("price_pct"), 0.95).alias("scale"))
    return rows.join(F.broadcast(scale))  # one row


def unusual_turnover(bars: DataFrame, perf: DataFrame, code: str = "1w", base_days: int = 90, n: int = 10, least_base: float = BASE_TURNOVER) -> DataFrame:
    """Mean daily turnover of the period over that of the days before it, where the base is large enough; the ``n`` largest."""
    bounds = F.broadcast(period_bounds(bars, code))  # one row
    own = bars.join(bounds, F.col("date").between(F.date_sub("start", base_days), F.col("end")))
    means = own.groupBy("ticker").agg(F.avg(F.when(F.col("date") >= F.col("start"), F.col("value_rub"))).alias("now"), F.avg(F.when(F.col("date") < F.col("start"), F.col("value_rub"))).alias("base"))
    busy = means.where(F.col("base") > least_base).withColumn("times", F.col("now") / F.col("base")).where("times is not null")
    return busy.join(perf.select("ticker", "price_pct"), "ticker").orderBy(F.desc("times"), "ticker").limit(n)


def unusual_moves(enriched: DataFrame, sigmas: float = 2.0, n: int = 10) -> DataFrame:
    return enriched.where(F.abs("sigma_move") >= sigmas).orderBy(F.desc(F.abs("sigma_move")), "ticker").limit(n)


def latest_rows(bars: DataFrame) -> DataFrame:
    return keep_last(bars, ["ticker"], F.desc("date"))


def comparable(bars: DataFrame, anchor: str, lookback: int = 45, stale: int = 30, price: str = "close") -> DataFrame:
    """Each ticker's last bar up to the anchor (at most ``lookback`` days old) against its last bar overall (at most ``stale`` days old)."""
    at = F.lit(anchor).cast("date")
    cap = F.col("market_cap") if "market_cap" in bars.columns else F.lit(None).cast("double")
    rows = bars.where(F.col(price) > 0).select("ticker", "date", F.col(price).alias("px"), cap.alias("cap"))
    then = rows.where(F.col("date").between(F.date_sub(at, lookback), at)).groupBy("ticker").agg(F.max_by("px", "date").alias("then_px"), F.max_by("cap", "date").alias("then_cap"))
    last = rows.groupBy("ticker").agg(F.max("date").alias("last_date"), F.max_by("px", "date").alias("now_px"), F.max_by("cap", "date").alias("now_cap"))
    latest = F.broadcast(rows.agg(F.max("date").alias("latest")))  # one row
    now = last.join(latest, F.col("last_date") >= F.date_sub("latest", stale)).drop("latest", "last_date")
    return then.join(now, "ticker").withColumn("pct", (F.col("now_px") / F.col("then_px") - 1) * 100)


def structure_vs_anchor(bars: DataFrame, anchor: str, least: int = 5) -> DataFrame:
    """Market structure then and now: changes, total caps, share of the five largest; no row below ``least`` comparable tickers, caps null
    below ``least`` with caps."""
    rows = comparable(bars, anchor)
    both = F.col("then_cap").isNotNull() & F.col("now_cap").isNotNull()
    for side in ("then", "now"):
        rows = rows.withColumn(f"{side}_rank", F.row_number().over(W.orderBy(F.when(both, F.col(f"{side}_cap")).desc_nulls_last(), "ticker")))
    enough = F.count_if(both) >= least
    top = lambda side: F.when(enough, 100 * F.sum(F.when(both & (F.col(f"{side}_rank") <= 5), F.col(f"{side}_cap"))) / F.sum(F.when(both, F.col(f"{side}_cap")))).alias(f"top5_{side}")
    total = lambda side: F.when(enough, F.sum(F.when(both, F.col(f"{side}_cap")))).alias(f"cap_{side}")
    return rows.agg(F.count("*").alias("n"), F.count_if(F.col("pct") > 0).alias("n_up"), F.count_if(F.col("pct") < 0).alias("n_down"), F.median("pct").alias("median_pct"), total("then"), total("now"), top("then"), top("now")).where(F.col("n") >= least)


def contributions(comparables: DataFrame, n: int = 12) -> DataFrame:
    """Each ticker's part in the change of total cap, in percentage points; the ``n`` largest either way."""
    known = comparables.where("then_cap is not null and now_cap is not null")
    part = 100 * (F.col("now_cap") - F.col("then_cap")) / F.sum("then_cap").over(W.partitionBy())
    return known.select("ticker", part.alias("contribution")).orderBy(F.desc(F.abs("contribution")), "ticker").limit(n)


def sector_weights(comparables: DataFrame, sectors: DataFrame) -> DataFrame:
    """Cap shares of sectors then and now, in percent."""
    sums = with_sector(comparables, sectors).groupBy("sector").agg(F.sum("then_cap").alias("then_cap"), F.sum("now_cap").alias("now_cap"))
    share = lambda c: (100 * F.col(c) / F.sum(c).over(W.partitionBy()))
    return sums.select("sector", share("then_cap").alias("then_share"), share("now_cap").alias("now_share"))


def filled_closes(bars: DataFrame) -> DataFrame:
    """Dense closes, filled forward and then backward."""
    return dense_closes(bars).withColumn("px", fill(F.col("px"), by_date()))


def sign_flags(ret: Column, threshold: float) -> Column:
    """1 above, -1 below, 0 within ``threshold``."""
    return F.when(ret > threshold, 1).when(ret < -threshold, -1).otherwise(0)
