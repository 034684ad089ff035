"""Security metrics, rolling risk, drawdowns, distributions and growth rates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.core import drawdown, first_value, kurtosis_adjusted, ratio, rolling, skew_adjusted
from ..functions.quantiles import exact_percentiles
from ..functions.series import rolling_columns
from ..schemas import DAYS, YEAR_DAYS
from ..scratch import durable
from .performance import by_date, with_returns

#: Common returns that beta, correlation and alpha need.
LEAST_COMMON = 30


def choose_benchmark(total_return: DataFrame, price: DataFrame, least: int = 2) -> DataFrame:
    """The total-return index, or the price index if that has fewer than ``least`` rows."""
    return total_return if total_return.limit(least).count() >= least else price


def security_metrics(bars: DataFrame, benchmark: DataFrame, price: str = "close", total: str = "adj_close") -> DataFrame:
    """One row for each ticker: price and total return, growth rates, volatility, Sharpe, tail, moments, drawdowns, and the relation to the benchmark."""
    total = total if total in bars.columns else price
    w = by_date()
    rows = bars.where(F.col(price) > 0).select("ticker", "date", F.col(price).alias("px"), F.col(total).alias("tr"))
    rows = with_returns(rows, "tr").withColumn("dd", drawdown(F.col("tr"), w))
    idx = benchmark.select("date", (ratio(F.col("close"), F.lag("close").over(W.orderBy("date"))) - 1).alias("idx"), F.col("close").alias("idx_close"))
    rows = rows.join(F.broadcast(idx), "date", "left")  # one row a day
    both = F.col("ret").isNotNull() & F.col("idx").isNotNull()
    x, y = F.when(both, F.col("ret")), F.when(both, F.col("idx"))
    end = F.max("date")
    out = rows.withColumn("last_date", F.max("date").over(W.partitionBy("ticker"))).groupBy("ticker").agg(
        F.min("date").alias("first_date"), end.alias("end_date"), F.min_by("px", "date").alias("px0"), F.max_by("px", "date").alias("px1"), F.min_by("tr", "date").alias("tr0"), F.max_by("tr", "date").alias("tr1"),
        F.stddev_samp("ret").alias("sd"), F.stddev_samp(F.when(F.col("ret") < 0, F.col("ret"))).alias("sd_down"), F.avg("ret").alias("mean"), F.percentile("ret", 0.05).alias("var5"),
        skew_adjusted(F.col("ret")).alias("skew"), kurtosis_adjusted(F.col("ret")).alias("kurt"), F.min("dd").alias("max_dd"), F.max_by("dd", "date").alias("dd_now"),
        F.max(F.when(F.col("date") >= F.add_months("last_date", -12), F.col("px"))).alias("high"), F.min(F.when(F.col("date") >= F.add_months("last_date", -12), F.col("px"))).alias("low"),
        F.count(x).alias("n_common"), F.covar_samp(x, y).alias("cov"), F.var_samp(y).alias("idx_var"), F.corr(x, y).alias("corr"), F.avg(x).alias("mean_x"), F.avg(y).alias("mean_y"),
        F.min_by("idx_close", F.when(F.col("idx_close").isNotNull(), F.col("date"))).alias("idx0"), F.max_by("idx_close", F.when(F.col("idx_close").isNotNull(), F.col("date"))).alias("idx1"),
    )
    years = F.datediff("end_date", "first_date") / YEAR_DAYS
    cagr = lambda a, b: F.when(years > 0, (F.pow(F.col(b) / F.col(a), 1 / years) - 1) * 100)
    related = (F.col("n_common") > LEAST_COMMON) & (F.col("idx_var") > 0)
    beta = ratio(F.col("cov"), F.col("idx_var"))
    return out.select(
        "ticker", ((F.col("px1") / F.col("px0") - 1) * 100).alias("price_return"), ((F.col("tr1") / F.col("tr0") - 1) * 100).alias("total_return"), cagr("px0", "px1").alias("price_cagr"), cagr("tr0", "tr1").alias("total_cagr"),
        (cagr("tr0", "tr1") - cagr("px0", "px1")).alias("dividend_yield"), (F.col("sd") * DAYS**0.5 * 100).alias("vol"), (F.col("sd_down") * DAYS**0.5 * 100).alias("down_vol"), (ratio(F.col("mean"), F.nullif(F.col("sd"), F.lit(0.0))) * DAYS**0.5).alias("sharpe"),
        (F.col("var5") * 100).alias("var5"), "skew", "kurt", (F.col("max_dd") * 100).alias("max_drawdown"), (F.col("dd_now") * 100).alias("drawdown"), ((F.col("px1") / F.col("high") - 1) * 100).alias("from_high"), ((F.col("px1") / F.col("low") - 1) * 100).alias("from_low"),
        ((F.col("tr1") / F.col("tr0")) / (F.col("idx1") / F.col("idx0")) * 100 - 100).alias("relative"), F.when(related, beta).alias("beta"), F.when(related, F.col("corr")).alias("corr"), F.when(related, (F.col("mean_x") - beta * F.col("mean_y")) * DAYS * 100).alias("alpha"),
    )


def rebased(bars: DataFrame, price: str = "close") -> DataFrame:
    """Adds ``rebased``: the price as a share of the ticker's first, times 100."""
    return bars.withColumn("rebased", 100 * F.col(price) / first_value(F.col(price), W.partitionBy("ticker").orderBy("date")))


def relative_strength(bars: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``ticker, date, rs``: the ratio to the benchmark on common dates, 100 at the first."""
    idx = benchmark.select("date", F.col("close").alias("idx")).dropna()
    both = bars.select("ticker", "date", "close").dropna().join(F.broadcast(idx), "date").withColumn("q", F.col("close") / F.col("idx"))
    return both.select("ticker", "date", (100 * F.col("q") / first_value(F.col("q"), W.partitionBy("ticker").orderBy("date"))).alias("rs"))


def rolling_beta_corr(bars: DataFrame, benchmark: DataFrame, n: int = 126, split: str | None = None) -> DataFrame:
    """Rolling beta and correlation over ``n`` common returns. ``split``, a unit of time, cuts histories too long for one task each."""
    idx = benchmark.select("date", F.col("close").alias("idx")).dropna()
    both = bars.select("ticker", "date", "close").dropna().join(F.broadcast(idx), "date")
    frame = lambda w: w.rowsBetween(-(n - 1), W.currentRow)
    full = lambda w: F.count("r").over(frame(w)) >= n
    columns = {
        "r": lambda w: ratio(F.col("close"), F.lag("close").over(w)) - 1,
        "m": lambda w: ratio(F.col("idx"), F.lag("idx").over(w)) - 1,
        "beta": lambda w: F.when(full(w), ratio(F.covar_samp("r", "m").over(frame(w)), F.nullif(F.var_samp("m").over(frame(w)), F.lit(0.0)))),
        "corr": lambda w: F.when(full(w), F.corr("r", "m").over(frame(w))),
    }
    return rolling_columns(both, columns, n + 1, split).select("ticker", "date", "beta", "corr")


def rolling_vol(bars: DataFrame, windows: tuple[int, ...] = (30, 90, 252), split: str | None = None) -> DataFrame:
    """Yearly volatility over each window; null while a ticker has fewer returns than that. ``split`` as in ``rolling_beta_corr``."""
    columns = {"ret": lambda w: ratio(F.col("close"), F.lag("close").over(w)) - 1}
    columns |= {f"vol_{n}": lambda w, n=n: rolling(F.stddev_samp, "ret", n, w) * DAYS**0.5 * 100 for n in windows}
    return rolling_columns(bars.select("ticker", "date", "close"), columns, max(windows) + 1, split).drop("close", "ret")


def turnover_mean(bars: DataFrame, n: int = 20, split: str | None = None) -> DataFrame:
    return rolling_columns(bars.select("ticker", "date", "value_rub"), {f"turnover_ma{n}": lambda w: rolling(F.avg, "value_rub", n, w)}, n, split).drop("value_rub")


def drawdowns(bars: DataFrame, price: str = "close") -> DataFrame:
    return bars.where(F.col(price).isNotNull()).select("ticker", "date", (100 * drawdown(F.col(price), by_date())).alias("drawdown"))


def worst_drawdown(bars: DataFrame, price: str = "close") -> DataFrame:
    """``ticker, drawdown, date`` of the deepest point, the first of equals."""
    return drawdowns(bars, price).groupBy("ticker").agg(F.min("drawdown").alias("drawdown"), F.min_by("date", F.struct("drawdown", "date")).alias("date"))


def histogram(df: DataFrame, value: str, bins: int = 60, by: str = "ticker") -> DataFrame:
    """Equal-width bins between the smallest and largest value: count, edges, and the normal density of the sample's mean and deviation at the centre."""
    known = df.where(F.col(value).isNotNull())
    lim = known.groupBy(by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.avg(value).alias("mu"), F.stddev_samp(value).alias("sd")).where("hi > lo and sd > 0")
    width = (F.col("hi") - F.col("lo")) / bins
    bin_ = F.least(F.floor((F.col(value) - F.col("lo")) / width), F.lit(bins - 1)).cast("int")
    counts = known.join(lim, by).groupBy(by, "lo", "hi", "mu", "sd", bin_.alias("bin")).agg(F.count("*").alias("n"))
    left = F.col("lo") + F.col("bin") * width
    z = (left + width / 2 - F.col("mu")) / F.col("sd")
    return counts.select(by, "bin", "n", left.alias("left"), (left + width).alias("right"), (F.exp(-z * z / 2) / (F.col("sd") * (2 * 3.141592653589793) ** 0.5)).alias("normal"))


def inverse_normal(p: Column) -> Column:
    """Quantiles of the normal distribution by a published rational approximation with an error below 4.5e-4."""
    t = F.sqrt(-2 * F.ln(F.least(p, 1 - p)))
    z = t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t * t * t)
    return F.when(p < 0.5, -z).otherwise(z)


def qq_points(df: DataFrame, value: str, by: str = "ticker") -> DataFrame:
    """Sample quantiles against those of a normal distribution, at plotting positions (i - 0.5) / n."""
    w = W.partitionBy(by).orderBy(value)
    rows = df.where(F.col(value).isNotNull()).select(by, F.col(value).alias("sample"), ((F.row_number().over(w) - 0.5) / F.count("*").over(W.partitionBy(by))).alias("p"))
    return rows.select(by, "sample", "p", inverse_normal(F.col("p")).alias("theory"))


def valid_prices(bars: DataFrame, price: str = "close", low: float = 0.01, high: float = 1000.0) -> DataFrame:
    """Positive prices within a band around the ticker's median."""
    ok = bars.where(F.col(price) > 0)
    mid = ok.groupBy("ticker").agg(F.median(price).alias("_mid"))
    return ok.join(mid, "ticker").where(F.col(price).between(low * F.col("_mid"), high * F.col("_mid"))).drop("_mid")


def complete_tickers(bars: DataFrame, start: str, days: int = 30) -> DataFrame:
    """Bars of tickers that begin within ``days`` of the start and end within ``days`` of the latest date."""
    latest = F.broadcast(bars.agg(F.max("date").alias("_latest")))  # one row
    span = bars.groupBy("ticker").agg(F.min("date").alias("a"), F.max("date").alias("b")).join(latest)
    good = span.where((F.col("a") <= F.date_add(F.lit(start).cast("date"), days)) & (F.col("b") >= F.date_sub("_latest", days))).select("ticker")
    return bars.join(good, "ticker", "left_semi")


def return_stats(bars: DataFrame, rf: float = 0.0, price: str = "close") -> DataFrame:
    """Growth, volatility and Sharpe of each ticker from log returns; years are returns over 252."""
    rets = with_returns(valid_prices(bars, price), price, log=True)
    out = rets.groupBy("ticker").agg(F.count("ret").alias("n"), F.sum("ret").alias("s"), (F.stddev_samp("ret") * DAYS**0.5).alias("vol")).where("n > 1")
    cagr = F.exp(F.col("s") / (F.col("n") / DAYS)) - 1
    return out.select("ticker", "n", cagr.alias("cagr"), "vol", ratio(cagr - rf, F.nullif(F.col("vol"), F.lit(0.0))).alias("sharpe"))


def growth_of_both(bars: DataFrame, price: str = "close", total: str = "adj_close") -> DataFrame:
    """Growth and volatility from log returns of the price and of the total return, and the difference: the dividend yield they imply."""
    own, full = (return_stats(bars, price=c).select("ticker", F.col("n").alias(f"n_{k}"), F.col("cagr").alias(f"{k}_cagr"), F.col("vol").alias(f"{k}_vol")) for c, k in ((price, "price"), (total, "total")))
    return own.join(full, "ticker").withColumn("dividend_yield", F.col("total_cagr") - F.col("price_cagr"))


def stats_summary(stats: DataFrame) -> DataFrame:
    """Means, medians and extremes of the growth figures; one row."""
    return stats.agg(
        F.count("*").alias("n"), F.avg("cagr").alias("mean_cagr"), F.median("cagr").alias("median_cagr"), F.avg("vol").alias("mean_vol"), F.median("vol").alias("median_vol"), F.avg("sharpe").alias("mean_sharpe"), F.median("sharpe").alias("median_sharpe"),
        F.max_by("ticker", F.struct("cagr", "ticker")).alias("best_cagr"), F.min_by("ticker", F.struct("cagr", "ticker")).alias("worst_cagr"), F.max_by("ticker", F.struct("sharpe", "ticker")).alias("best_sharpe"),
    )


def cagr_by_calendar(bars: DataFrame, start: str, price: str = "close", total: str = "adj_close", days: int = 30) -> DataFrame:
    """Yearly growth by calendar years of price and total return, the dividend yield they imply, and whether the history is full."""
    rows = bars.where((F.col("date") >= F.lit(start).cast("date")) & (F.col(price) > 0))
    latest = F.broadcast(rows.agg(F.max("date").alias("_latest")))
    out = rows.groupBy("ticker").agg(F.min("date").alias("a"), F.max("date").alias("b"), *[f(c, "date").alias(f"{c}_{k}") for c in {price, total} for k, f in (("first", F.min_by), ("last", F.max_by))]).join(latest)
    years = F.datediff("b", "a") / YEAR_DAYS
    rate = lambda c: F.when(years > 0, F.pow(F.col(f"{c}_last") / F.col(f"{c}_first"), 1 / years) - 1)
    full = (F.col("a") < F.date_add(F.lit(start).cast("date"), days)) & (F.col("b") > F.date_sub("_latest", days))
    return out.select("ticker", years.alias("years"), rate(price).alias("price_cagr"), rate(total).alias("total_cagr"), (rate(total) - rate(price)).alias("dividend_yield"), full.alias("full_history"))


def index_yearly(index_bars: DataFrame, days: int = 250) -> DataFrame:
    """Mean and deviation of daily log returns, on a year of ``days``; one row."""
    r = index_bars.select(F.ln(ratio(F.col("close"), F.lag("close").over(W.orderBy("date")))).alias("r"))
    return r.agg((F.avg("r") * days).alias("mean"), (F.stddev_samp("r") * float(days) ** 0.5).alias("sd"))


def describe(df: DataFrame, *cols: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of numeric columns, a row for each. No task holds a column's values."""
    quartiles = (0.25, 0.5, 0.75)
    own = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols])).alias("s")).select("s.column", "s.v")
    own = durable(own, "described")
    sums = own.groupBy("column").agg(F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"), F.min("v").alias("min"), F.max("v").alias("max"))
    at = exact_percentiles(own, "v", quartiles, ["column"])
    return sums.join(at, "column", "left").select("column", "count", "mean", "std", "min", *[F.get("percentiles", F.lit(i)).alias(f"p{int(q * 100)}") for i, q in enumerate(quartiles)], "max")
