"""Time-series diagnostics and forecasts.

What sums over lags is native; least squares per ticker are grouped maps over one security's history. Order and parameter grids are
rows, so (ticker, candidate) pairs run in parallel. ARMA orders are fitted by Hannan-Rissanen least squares and GARCH by a scan of
likelihoods over a parameter grid: both approximate maximum likelihood.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.core import chi2_sf_even, ratio, rolling
from ..functions.series import recurrences
from ..functions.linear import eliminate, gram, interpolate, lag_gram, lag_sums, nested_residuals, normal_cdf, polynomial
from ..schemas import DAYS
from ..scratch import durable
from .performance import by_date, with_returns

#: Returns that stationarity tests, order grids and forecasts need.
LEAST_TEST, LEAST_GRID, LEAST_FORECAST = 30, 60, 100
#: The response surface of the Dickey-Fuller distribution with a constant (normal quantiles as polynomials of the statistic,
#: highest power first, up to and above a border, and where p is 0 and 1), and the KPSS test's critical values with their significance.
ADF_SMALL, ADF_LARGE = (0.038269, 1.4412, 2.1659), (-0.010368, -0.12745, 0.93202, 1.7339)
ADF_BORDER, ADF_LEAST, ADF_MOST = -1.61, -18.83, 2.74
KPSS_POINTS = ((0.347, 0.10), (0.463, 0.05), (0.574, 0.025), (0.739, 0.01))
#: Values before a row that an ARMA order is fitted from: innovations come from a long autoregression of ``INNOVATION_LAGS``.
INNOVATION_LAGS, MOST_ORDER = 12, 3


def log_returns(bars: DataFrame, price: str = "close") -> DataFrame:
    rows = bars.where(F.col(price) > 0).select("ticker", "date", price)
    return with_returns(rows, price, log=True).where("ret is not null").select("ticker", "date", "ret")


def acf(df: DataFrame, value: str = "ret", lags: int = 25, by: str = "ticker", time: str = "date") -> DataFrame:
    """``by, lag, acf, n``: autocorrelations of lags 1 to ``lags``, with one sort for all of them."""
    w, all_ = W.partitionBy(by).orderBy(time), W.partitionBy(by)
    x = df.where(F.col(value).isNotNull()).select(by, time, (F.col(value) - F.avg(value).over(all_)).alias("x"))
    cross = x.select(by, "x", *[F.lag("x", k).over(w).alias(f"_l{k}") for k in range(1, lags + 1)])
    sums = cross.groupBy(by).agg(F.count("*").alias("n"), F.sum(F.col("x") * F.col("x")).alias("ss"), *[F.sum(F.col("x") * F.col(f"_l{k}")).alias(f"c{k}") for k in range(1, lags + 1)])
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), ratio(F.col(f"c{k}"), F.nullif(F.col("ss"), F.lit(0.0))).alias("acf")) for k in range(1, lags + 1)]))
    return sums.select(by, "n", rows.alias("r")).select(by, "r.lag", "r.acf", "n").where(F.col("lag") < F.col("n"))


def pacf(autocorrelations: DataFrame, by: str = "ticker") -> DataFrame:
    """``by, lag, pacf`` from ``acf`` by the Durbin-Levinson recursion, over an array of a series' few autocorrelations."""
    rho = F.transform(F.array_sort(F.collect_list(F.struct("lag", "acf"))), lambda s: s["acf"])
    arrays = autocorrelations.where("acf is not null").groupBy(by).agg(rho.alias("rho"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)
    empty = F.array().cast("array<double>")

    def step(acc: Column, k: Column) -> Column:
        phi, known = acc["phi"], F.slice("rho", 1, k)
        last = F.coalesce(ratio(F.get("rho", k) - dot(phi, F.reverse(known)), F.nullif(1 - dot(phi, known), F.lit(0.0))), F.lit(0.0))
        return F.struct(F.concat(F.zip_with(phi, F.reverse(phi), lambda a, b: a - last * b), F.array(last)).alias("phi"), F.concat(acc["out"], F.array(last)).alias("out"))

    found = F.aggregate(F.sequence(F.lit(0), F.size("rho") - 1), F.struct(empty.alias("phi"), empty.alias("out")), step)["out"]
    return arrays.select(by, F.posexplode(found).alias("_p", "pacf")).select(by, (F.col("_p") + 1).alias("lag"), "pacf")


def portmanteau(autocorrelations: DataFrame, lags: tuple[int, ...] = (10, 20), by: str = "ticker") -> DataFrame:
    """Ljung-Box and Box-Pierce statistics and p-values at even numbers of lags."""
    out = []
    for m in lags:
        own = autocorrelations.where(F.col("lag") <= m).groupBy(by).agg(
            (F.max("n") * (F.max("n") + 2) * F.sum(F.pow("acf", 2) / (F.col("n") - F.col("lag")))).alias("ljung_box"), (F.max("n") * F.sum(F.pow("acf", 2))).alias("box_pierce")
        )
        out.append(own.select(by, F.lit(m).alias("lags"), "ljung_box", chi2_sf_even(F.col("ljung_box"), m).alias("ljung_box_p"), "box_pierce", chi2_sf_even(F.col("box_pierce"), m).alias("box_pierce_p")))
    found = out[0]
    for o in out[1:]:
        found = found.unionByName(o)
    return found


def _ols(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    return beta, y - x @ beta


def _lagged(x: np.ndarray, p: int, start: int) -> np.ndarray:
    return np.column_stack([x[start - k : len(x) - k] for k in range(1, p + 1)]) if p else np.empty((len(x) - start, 0))


def arch_lm(df: DataFrame, value: str = "ret", lags: int = 10, by: str = "ticker", time: str = "date") -> DataFrame:
    """Engle's test: n R² of the squares on their lags, chi-square with ``lags`` (even) degrees of freedom; null up to 3 ``lags`` values.

    The sums of products are one aggregate, the regression an elimination in its columns.
    """
    w = W.partitionBy(by).orderBy(time)
    square = F.pow(F.col(value).cast("double"), 2)
    rows = df.where(F.col(value).isNotNull()).select(by, square.alias("y"), *[F.lag(square, k).over(w).alias(f"l{k}") for k in range(1, lags + 1)])
    used = rows.where(F.col(f"l{lags}").isNotNull())
    size = lags + 2
    sums = used.groupBy(by).agg(F.count("*").alias("m"), gram(F.lit(1.0), *[F.col(f"l{k}") for k in range(1, lags + 1)], F.col("y")).alias("g"))
    left = lambda pivots: F.element_at(eliminate(F.col("g"), size, pivots), size * size)
    stat = F.when(F.col("m") > 2 * lags, F.col("m") * (1 - ratio(F.col("around_plane"), F.nullif(F.col("around_mean"), F.lit(0.0)))))
    found = sums.select(by, "m", left(1).alias("around_mean"), left(lags + 1).alias("around_plane")).select(by, stat.alias("arch_lm"))
    out = df.where(F.col(value).isNotNull()).select(by).distinct().join(found, by, "left")
    return out.select(by, "arch_lm", chi2_sf_even(F.col("arch_lm"), lags).alias("arch_lm_p"))


def kpss(df: DataFrame, value: str = "ret", by: str = "ticker", time: str = "date") -> DataFrame:
    """``by, n, kpss, kpss_lags, kpss_p``: the KPSS test of a level with the automatic bandwidth of Hobijn and others; needs more than 30
    values. p lies between 0.01 and 0.1, as its table does.

    The long-run variance under Bartlett weights of L lags is the mean square of the sums of L + 1 values in a row over L + 1, so any
    bandwidth takes one join of the running sums with themselves instead of a pass for each lag.
    """
    w, all_ = W.partitionBy(by).orderBy(time), W.partitionBy(by)
    x = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull()).select(by, time, (x - F.avg(x).over(all_)).alias("e"), F.count("*").over(all_).alias("n")).where(F.col("n") > LEAST_TEST)
    rows = rows.withColumns({"i": F.row_number().over(w), "run": F.sum("e").over(w.rowsBetween(W.unboundedPreceding, W.currentRow))})
    longest = rows.agg(F.max("n")).first()[0] or 0
    steps = range(1, int(longest ** (2 / 9) + 1e-9) + 1)
    lagged = rows.select("*", *[F.lag("e", k).over(w).alias(f"_l{k}") for k in steps])
    near = lambda k, c: F.when(F.lit(k) <= F.floor(F.pow("n", F.lit(2 / 9))), c).otherwise(0.0)
    products = lambda weight: sum((near(k, weight(k) * F.coalesce(F.col(f"_c{k}"), F.lit(0.0))) for k in steps), F.lit(0.0))
    sums = lagged.groupBy(by).agg(F.max("n").alias("n"), F.sum(F.col("e") * F.col("e")).alias("ss"), F.sum(F.col("run") * F.col("run")).alias("area"), *[F.sum(F.col("e") * F.col(f"_l{k}")).alias(f"_c{k}") for k in steps])
    ratio_ = ratio(products(lambda k: 2.0 * k), F.nullif(F.col("ss") + products(lambda k: 2.0), F.lit(0.0)))
    bandwidth = F.least(F.floor(1.1447 * F.pow(ratio_ * ratio_, 1 / 3) * F.pow(F.col("n"), 1 / 3)), F.col("n") - 1)
    found = sums.select(by, "n", "ss", "area", F.coalesce(bandwidth, F.lit(0)).cast("long").alias("band"))

    runs = rows.select(by, "i", "n", "run").join(found.select(by, "band"), by)
    before = runs.select(by, (F.col("i") + F.col("band") + 1).alias("i"), F.col("run").alias("past"))
    # sums of band + 1 values that end in the series, then those that begin in it and end behind it, where the running sum is 0
    spans = runs.join(before, [by, "i"], "left").select(by, F.pow(F.col("run") - F.coalesce("past", F.lit(0.0)), 2).alias("q"), F.when(F.col("i") >= F.col("n") - F.col("band"), F.pow("run", 2)).otherwise(0.0).alias("rest"))
    squares = spans.groupBy(by).agg((F.sum("q") + F.sum("rest")).alias("q"))
    n = F.col("n")
    stat = ratio(F.col("area") / (n * n), F.nullif(F.col("q") / (n * (F.col("band") + 1)), F.lit(0.0)))
    out = found.join(squares, by).select(by, "n", F.when(F.col("ss") > 0, stat).alias("kpss"), F.col("band").alias("kpss_lags"))
    return out.withColumn("kpss_p", interpolate(F.col("kpss"), KPSS_POINTS))


def adf(df: DataFrame, value: str = "ret", by: str = "ticker", time: str = "date") -> DataFrame:
    """``by, adf, adf_lags, adf_p``: the augmented Dickey-Fuller test with a constant, its lags by AIC among up to 12 (n / 100)^(1/4) of
    them on one sample, the statistic from all rows that the chosen lags leave; needs more than 30 values.

    Spark sums the lagged products; one Cholesky factor of a ticker's matrix has the residuals of all lags.
    """
    w = W.partitionBy(by).orderBy(time)
    x = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull()).select(by, time, x.alias("level"), F.count("*").over(W.partitionBy(by)).alias("n")).where(F.col("n") > LEAST_TEST)
    longest = rows.agg(F.max("n")).first()[0] or 0
    lags = _most_lags(longest)
    steps = rows.select(by, time, (F.col("level") - F.lag("level").over(w)).alias("d"), F.lag("level").over(w).alias("y")).where("d is not null")
    sums = lag_sums(steps, "d", lags, [by], time).join(_level_sums(steps, lags, by, time), by)

    @F.pandas_udf("adf double, adf_lags long")
    def test(n: pd.Series, total: pd.Series, products: pd.Series, head: pd.Series, tail: pd.Series, level: pd.Series, first_levels: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_dickey_fuller(*row) for row in zip(n, total, products, head, tail, level, first_levels)], columns=["adf", "adf_lags"])

    found = sums.select(by, test("n", "total", "products", "head", "tail", "level", "first_levels").alias("t")).select(by, "t.adf", "t.adf_lags")
    stat = F.nanvl("adf", F.lit(None).cast("double"))
    p = F.when(stat <= ADF_LEAST, 0.0).when(stat > ADF_MOST, 1.0).when(stat <= ADF_BORDER, normal_cdf(polynomial(stat, ADF_SMALL))).otherwise(normal_cdf(polynomial(stat, ADF_LARGE)))
    return found.select(by, stat.alias("adf"), F.when(stat.isNotNull(), F.col("adf_lags")).alias("adf_lags"), F.when(stat.isNotNull(), p).alias("adf_p"))


def _most_lags(n: int) -> int:
    return max(min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2), 0)


def _level_sums(steps: DataFrame, lags: int, by: str, time: str) -> DataFrame:
    """``by, level, first_levels``: sums of the level before each step, of its square, and of its products with the step k before; and the
    first levels."""
    w = W.partitionBy(by).orderBy(time)
    rows = steps.select(by, "y", "d", F.row_number().over(w).alias("i"), *[F.lag("d", k).over(w).alias(f"l{k}") for k in range(1, lags + 1)])
    cross = [F.coalesce(F.sum(F.col("y") * F.col(f"l{k}")), F.lit(0.0)) for k in range(1, lags + 1)]
    first = F.transform(F.array_sort(F.collect_list(F.when(F.col("i") <= lags, F.struct("i", "y")))), lambda s: s["y"])
    return rows.groupBy(by).agg(F.array(F.sum("y"), F.sum(F.col("y") * F.col("y")), F.sum(F.col("y") * F.col("d")), *cross).alias("level"), first.alias("first_levels"))


def _dickey_fuller(n: int, total: float, products: np.ndarray, head: np.ndarray, tail: np.ndarray, level: np.ndarray, first_levels: np.ndarray) -> tuple[float, int]:
    """The statistic and its number of lags from the sums over the ``n`` steps of one series."""
    if not products[0] > 0:
        return math.nan, 0

    def matrix(lags: int, first: int) -> np.ndarray:
        """Of (1, level, steps 1 to ``lags`` before, step) over the steps behind ``first``."""
        g = lag_gram(n, total, products, head, tail, lags, first)
        y = first_levels[:first]
        with_level = np.array([level[0] - y.sum(), *[level[2 + k] - y[k:] @ head[: first - k] for k in range(lags + 1)]])
        full = np.empty((lags + 3, lags + 3))
        order = [0, *range(2, lags + 2), 1]  # 1, lags, step
        at = [0, *range(2, lags + 3)]
        full[np.ix_(at, at)] = g[np.ix_(order, order)]
        full[1, 1] = level[1] - y @ y
        full[1, at] = full[at, 1] = np.array([with_level[0], *with_level[2:], with_level[1]])
        return full

    most = _most_lags(n + 1)
    try:
        m = n - most
        rss = nested_residuals(matrix(most, most))[1:]  # with the constant and the level, then one lag more each
        aic = m * np.log(np.maximum(rss / m, 1e-300)) + 2 * (np.arange(len(rss)) + 2)
        lags = int(aic.argmin())
        # the level last: what is left of it and of its product with the step gives the coefficient and its error
        g = matrix(lags, lags)
        order = [0, *range(2, lags + 2), 1, lags + 2]
        g = g[np.ix_(order, order)]
        k = lags + 1
        left = g[k:, k:] - g[k:, :k] @ np.linalg.solve(g[:k, :k], g[:k, k:])
        beta = left[0, 1] / left[0, 0]
        s2 = (left[1, 1] - beta * left[0, 1]) / (n - lags - (lags + 2))
        return float(beta / math.sqrt(s2 / left[0, 0])), lags
    except (np.linalg.LinAlgError, ValueError, ZeroDivisionError):  # a singular matrix: no test
        return math.nan, 0


def stationarity(df: DataFrame, value: str = "ret", by: str = "ticker", time: str = "date") -> DataFrame:
    """``by, n``, statistic, lags and p-value of the augmented Dickey-Fuller test, whose null is a unit root, and of the KPSS test, whose null
    is a stationary level. A series of up to 30 values has nulls."""
    n = df.where(F.col(value).isNotNull()).groupBy(by).agg(F.count("*").alias("n"))
    return n.join(adf(df, value, by, time), by, "left").join(kpss(df, value, by, time).drop("n"), by, "left").select(by, "n", "adf", "adf_lags", "adf_p", "kpss", "kpss_lags", "kpss_p")


def hannan_rissanen(x: np.ndarray, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (constant, AR, MA) and residuals of an ARMA(p, q): innovations from a long autoregression, then least squares on both."""
    long = min(max(10, 2 * (p + q)), len(x) // 4)
    if q:
        _, e = _ols(np.column_stack([np.ones(len(x) - long), _lagged(x, long, long)]), x[long:])
        e = np.concatenate([np.zeros(long), e])
    else:
        e, long = np.zeros(len(x)), 0
    start = long + max(p, q)
    return _ols(np.column_stack([np.ones(len(x) - start), _lagged(x, p, start), _lagged(e, q, start)]), x[start:])


def arma_grid(returns: DataFrame, most: int = MOST_ORDER, differences: tuple[int, ...] = (0, 1), by: str = "ticker", time: str = "date") -> DataFrame:
    """``by, p, d, q, aic, bic, rank``: orders up to ``most`` of the series differenced ``d`` times; approximate; (0, d, 0) is left out.

    Innovations are the residuals of an autoregression of ``INNOVATION_LAGS``, hence combinations of lagged values. So one matrix of lagged
    products, summed in one pass after one shuffle, holds the regressions of all orders, on the same rows.
    """
    lags = INNOVATION_LAGS + most
    w = W.partitionBy(by).orderBy(time)
    rows = returns.where("ret is not null").select(by, time, F.col("ret").cast("double").alias("x0"))
    for d in range(1, max(differences) + 1):
        rows = rows.withColumn(f"x{d}", F.col(f"x{d - 1}") - F.lag(f"x{d - 1}").over(w))
    rows = rows.withColumn("have", F.count("*").over(W.partitionBy(by))).where(F.col("have") > LEAST_GRID)
    dealt = rows.select(by, time, F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.col(f"x{d}").alias("x")) for d in differences])).alias("s")).select(by, time, "s.d", "s.x")
    sums = lag_sums(dealt, "x", lags, [by, "d"], time)

    @F.pandas_udf("array<struct<p:int,q:int,aic:double,bic:double>>")
    def orders(n: pd.Series, total: pd.Series, products: pd.Series, head: pd.Series, tail: pd.Series) -> pd.Series:
        return pd.Series([_orders(lag_gram(*row, lags, lags), most) for row in zip(n, total, products, head, tail)])

    found = sums.select(by, "d", F.explode(orders("n", "total", "products", "head", "tail")).alias("o")).select(by, "o.p", "d", "o.q", "o.aic", "o.bic")
    return found.withColumn("rank", F.row_number().over(W.partitionBy(by).orderBy("aic", "p", "d", "q")))


def innovations(g: np.ndarray, long: int) -> np.ndarray:
    """Coefficients (constant, lags) of the autoregression of order ``long`` from a matrix of lagged products."""
    own = [0, *range(2, long + 2)]
    return np.linalg.lstsq(g[np.ix_(own, own)], g[own, 1], rcond=None)[0]


def with_innovations(width: int, beta: np.ndarray, p: int, q: int) -> np.ndarray:
    """Rows that make (1, x_t, x's ``p`` lags, ``q`` lags of the innovations) of (1, x_t, x_{t-1}, ...): an innovation is its value less what
    the autoregression ``beta`` says of it."""
    rows = np.zeros((2 + p + q, width))
    rows[np.arange(2 + p), np.arange(2 + p)] = 1.0
    for j in range(1, q + 1):
        rows[1 + p + j, 1 + j] += 1.0
        rows[1 + p + j, 0] -= beta[0]
        rows[1 + p + j, 2 + j : 2 + j + len(beta) - 1] -= beta[1:]
    return rows


def _orders(g: np.ndarray, most: int) -> list[dict]:
    beta, n, out = innovations(g, INNOVATION_LAGS), g[0, 0], []
    for p in range(most + 1):
        for q in range(most + 1):
            if p + q:
                t = with_innovations(len(g), beta, p, q)
                m = t @ g @ t.T
                own = [0, *range(2, len(m))]
                coefficients = np.linalg.lstsq(m[np.ix_(own, own)], m[own, 1], rcond=None)[0]
                rss = m[1, 1] - coefficients @ m[own, 1]
                ll = n * math.log(max(rss / n, 1e-300))
                out.append({"p": p, "q": q, "aic": float(ll + 2 * (p + q + 1)), "bic": float(ll + math.log(n) * (p + q + 1))})
    return out


#: The grid of sums of the coefficients of squares and of variances.
GARCH_ALPHAS, GARCH_BETAS = (0.02, 0.05, 0.08, 0.12, 0.16, 0.2, 0.3), (0.3, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.94)
GARCH_GRID = tuple((a, b) for a in GARCH_ALPHAS for b in GARCH_BETAS if a + b < 0.999)


def garch_grid(returns: DataFrame, p: int = 1, q: int = 1, by: str = "ticker", time: str = "date", split: str | None = None) -> DataFrame:
    """``by, date, alpha, beta, cond_vol, std_resid``: the GARCH(p, q) of the best likelihood among a grid of parameters, its variance
    targeted to the sample's; approximate. (1, 1) is native; other orders go through time once for all candidates, ticker by ticker.

    ``alpha`` and ``beta`` are the sums over the ``p`` lags of squares and the ``q`` of variances; each lag has half the weight of the one
    before. Needs more than 60 values.
    """
    if p == q == 1:
        return _garch_1_1(returns, by, time, split)
    return _garch_by_ticker(returns, p, q, by, time)


def _garch_1_1(returns: DataFrame, by: str, time: str, split: str | None) -> DataFrame:
    """All variances of a parameter pair are its part of the mean, of the first variance, and ``alpha`` times a running sum of squares that
    ``beta`` forgets: one recurrence for each ``beta`` serves all pairs; ``split``, a unit of time, cuts histories that are too long for a task each."""
    have = returns.where("ret is not null").select(by, time, F.col("ret").cast("double").alias("ret"))
    stats = have.groupBy(by).agg(F.count("*").alias("_n"), F.avg("ret").alias("_mean"), F.greatest(F.var_pop("ret") * 1e4, F.lit(1e-12)).alias("_v")).where(F.col("_n") > LEAST_GRID)
    rows = have.join(stats, by).select(by, time, ((F.col("ret") - F.col("_mean")) * 100).alias("e"), "_v")
    before = lambda w: F.coalesce(F.lag(F.col("e") * F.col("e")).over(w), F.lit(0.0))
    columns = {f"s{k}": (before, b) for k, b in enumerate(GARCH_BETAS)} | {"t": (lambda _: F.col("_i"), 0.0)}
    rows = durable(recurrences(rows, columns, [by], time, chunk=split, look_back=1), "variances")

    def variance(a: Column, b: Column, squares: Column) -> Column:
        kept = F.pow(b, F.col("t"))
        return F.col("_v") * kept + F.col("_v") * (1 - a - b) * (1 - kept) / (1 - b) + a * squares

    of = lambda a, b: variance(F.lit(a), F.lit(b), F.col(f"s{GARCH_BETAS.index(b)}"))
    likelihood = lambda a, b: -0.5 * F.sum(F.log(of(a, b)) + F.col("e") * F.col("e") / of(a, b))
    scores = rows.groupBy(by).agg(F.array(*[likelihood(a, b) for a, b in GARCH_GRID]).alias("ll"))
    at = F.array_position("ll", F.array_max("ll")).cast("int")
    best = scores.select(by, F.element_at(F.array(*[F.lit(a) for a, _ in GARCH_GRID]), at).alias("alpha"), F.element_at(F.array(*[F.lit(b) for _, b in GARCH_GRID]), at).alias("beta"))
    squares = F.element_at(F.array(*[F.col(f"s{k}") for k in range(len(GARCH_BETAS))]), F.array_position(F.array(*[F.lit(b) for b in GARCH_BETAS]), F.col("beta")).cast("int"))
    sd = F.sqrt(variance(F.col("alpha"), F.col("beta"), squares))
    return rows.join(best, by).select(by, time, "alpha", "beta", sd.alias("cond_vol"), (F.col("e") / sd).alias("std_resid"))


def _garch_by_ticker(returns: DataFrame, p: int, q: int, by: str, time: str) -> DataFrame:
    grid = np.array(GARCH_GRID)
    halves = lambda n: 0.5 ** np.arange(n) / (0.5 ** np.arange(n)).sum()
    on_squares, on_variances = halves(p), halves(q)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(time)
        if len(pdf) <= LEAST_GRID:
            return pd.DataFrame([], columns=[by, time, "alpha", "beta", "cond_vol", "std_resid"])
        e = (pdf["ret"].to_numpy(float) - pdf["ret"].mean()) * 100
        v = max(e.var(), 1e-12)
        omega = v * (1 - grid.sum(1))
        squares, variances = np.full(p, v), np.full((q, len(grid)), v)  # the last ones, newest first
        path, ll = np.empty((len(e), len(grid))), np.zeros(len(grid))
        for i, x in enumerate(e):
            h = omega + grid[:, 0] * (on_squares @ squares) + grid[:, 1] * (on_variances @ variances) if i else np.full(len(grid), v)
            path[i] = h
            ll -= 0.5 * (np.log(h) + x * x / h)
            squares, variances = np.append(x * x, squares[:-1]), np.vstack([h, variances[:-1]])
        k = int(ll.argmax())
        sd = np.sqrt(path[:, k])
        return pd.DataFrame({by: pdf[by], time: pdf[time], "alpha": grid[k, 0], "beta": grid[k, 1], "cond_vol": sd, "std_resid": e / sd})

    return returns.select(by, time, "ret").groupBy(by).applyInPandas(run, f"{by} string, {time} date, alpha double, beta double, cond_vol double, std_resid double")


class GrowingArma:
    """Hannan-Rissanen fits of a growing past. ``advance`` adds the rows that are new to two matrices of lagged products and solves them, so that
    a refit costs as much as its new rows and not as the past; the coefficients are those of a fit to all of it."""

    def __init__(self, x: np.ndarray, p: int, q: int) -> None:
        self.x, self.p, self.q = x, p, q
        self.long = max(10, 2 * (p + q)) if q else 0
        self.width, self.first = max(p, self.long + q), self.long + max(p, q)
        self.done = {self.long: self.long, self.first: self.first}  # rows that are in, by the first of them
        size = self.width + 2
        self.of_long, self.of_all = np.zeros((self.long + 2, self.long + 2)), np.zeros((size, size))

    def _add(self, matrix: np.ndarray, key: int, until: int) -> None:
        at = self.done[key]
        if until > at:
            z = np.column_stack([np.ones(until - at), *[self.x[at - k : until - k] for k in range(len(matrix) - 1)]])
            matrix += z.T @ z
            self.done[key] = until

    def advance(self, until: int) -> tuple[np.ndarray, np.ndarray]:
        """Coefficients (constant, AR, MA) from the values before ``until``, and the last ``q`` residuals."""
        self._add(self.of_all, self.first, until)
        beta = np.zeros(1)
        if self.q:
            if self.long != self.first:
                self._add(self.of_long, self.long, until)
            beta = _solve(self.of_long)
        t = with_innovations(self.width + 2, beta, self.p, self.q)
        coefficients = _solve(t @ self.of_all @ t.T)
        return coefficients, self._residuals(t, coefficients, until)

    def _residuals(self, t: np.ndarray, coefficients: np.ndarray, until: int) -> np.ndarray:
        if not self.q:
            return np.empty(0)
        z = np.array([[1.0, *self.x[i - self.width : i + 1][::-1]] for i in range(until - self.q, until)]) @ t.T
        return z[:, 1] - np.delete(z, 1, axis=1) @ coefficients


def _solve(matrix: np.ndarray) -> np.ndarray:
    """Coefficients of the second variable of a Gram matrix on all others."""
    scale = np.sqrt(np.maximum(np.diag(matrix), 1e-300))
    m = matrix / np.outer(scale, scale)
    own = [0, *range(2, len(m))]
    a, b = m[np.ix_(own, own)], m[own, 1]
    try:
        found = np.linalg.solve(a, b)
    except np.linalg.LinAlgError:
        found = np.linalg.lstsq(a, b, rcond=None)[0]
    return found * scale[1] / scale[own]


def walk_forward_forecast(returns: DataFrame, p: int = 1, q: int = 1, train: float = 0.8, refit: int = 20, legacy_alignment: bool = False, by: str = "ticker", time: str = "date") -> DataFrame:
    """``by, date, actual, forecast, error``: one step ahead after the first ``train`` share, refitted every ``refit`` steps; needs 100 values
    and at most 10 coefficients. The time of a ticker grows with its number of values, not of refits times values.

    The forecast from values before i is compared with value i; ``legacy_alignment`` compares it with i + 1.
    """
    if p + q > 10:
        raise ValueError("p + q is above 10")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(time).reset_index(drop=True)
        x, rows = pdf["ret"].to_numpy(float), []
        if len(x) >= LEAST_FORECAST:
            first, fit = int(len(x) * train), GrowingArma(x, p, q)
            for i in range(first, len(x) - int(legacy_alignment)):
                if (i - first) % refit == 0:
                    beta, e = fit.advance(i)
                guess = float(beta[0] + beta[1 : p + 1] @ x[i - p : i][::-1] + beta[p + 1 :] @ e[::-1])
                at = i + int(legacy_alignment)
                rows.append((pdf[by].iat[0], pdf[time].iat[at], x[at], guess, x[at] - guess))
                if q:
                    e = np.append(e[1:], x[i] - guess)
        return pd.DataFrame(rows, columns=[by, time, "actual", "forecast", "error"])

    return returns.where("ret is not null").select(by, time, "ret").groupBy(by).applyInPandas(run, f"{by} string, {time} date, actual double, forecast double, error double")


def persistence_forecast(returns: DataFrame, by: str = "ticker", time: str = "date") -> DataFrame:
    """``by, date, actual, forecast, error``: tomorrow as today, the forecast that others are held against."""
    before = F.lag("ret").over(W.partitionBy(by).orderBy(time))
    return returns.where("ret is not null").select(by, time, F.col("ret").alias("actual"), before.alias("forecast"), (F.col("ret") - before).alias("error")).where("forecast is not null")


def forecast_errors(forecasts: DataFrame, by: str = "ticker") -> DataFrame:
    return forecasts.groupBy(by).agg(F.count("*").alias("n"), F.sqrt(F.avg(F.pow("error", 2))).alias("rmse"), F.avg(F.abs("error")).alias("mae"))


def rolling_rmse(forecasts: DataFrame, by: str = "ticker", time: str = "date", most: int = 20) -> DataFrame:
    """RMSE over the last min(``most``, n // 3) forecasts of each ticker; null before there are so many."""
    w = W.partitionBy(by).orderBy(time).rowsBetween(-(most - 1), W.currentRow)
    width = F.greatest(F.least(F.lit(most), F.floor(F.count("*").over(W.partitionBy(by)) / 3)), F.lit(1)).cast("int")
    rows = forecasts.select(by, time, width.alias("_w"), F.collect_list(F.pow("error", 2)).over(w).alias("_s"))
    last = F.aggregate(F.slice("_s", -F.col("_w"), F.col("_w")), F.lit(0.0), lambda acc, x: acc + x)
    return rows.select(by, time, F.when(F.size("_s") >= F.col("_w"), F.sqrt(last / F.col("_w"))).alias("rmse"))


def long_cash(forecasts: DataFrame, by: str = "ticker", time: str = "date") -> DataFrame:
    """Long where the forecast is positive, else in cash: total and yearly figures against holding, and the share of days long."""
    r = F.when(F.col("forecast") > 0, F.col("actual")).otherwise(0.0)
    return forecasts.withColumn("r", r).groupBy(by).agg(
        ((F.exp(F.sum("r")) - 1) * 100).alias("total_pct"), ((F.exp(F.sum("actual")) - 1) * 100).alias("hold_pct"), (ratio(F.avg("r"), F.nullif(F.stddev_samp("r"), F.lit(0.0))) * DAYS**0.5).alias("sharpe"), (100 * F.avg((F.col("forecast") > 0).cast("int"))).alias("long_pct")
    )


def forward_path(bars: DataFrame, steps: DataFrame, price: str = "close") -> DataFrame:
    """``ticker, date, price, low, high`` on the business days after the last bar from ``steps`` (ticker, step, forecast, half_width) of log
    returns. The bounds add up the steps' own, which is too wide: naive bounds."""
    last = bars.groupBy("ticker").agg(F.max("date").alias("_last"), F.max_by(price, "date").alias("_px"))
    w = W.partitionBy("ticker").orderBy("step").rowsBetween(W.unboundedPreceding, W.currentRow)
    run = lambda x: F.col("_px") * F.exp(F.sum(x).over(w))
    out = steps.join(last, "ticker").withColumn("date", business_day(F.col("_last"), F.col("step")))
    return out.select("ticker", "date", run(F.col("forecast")).alias("price"), run(F.col("forecast") - F.col("half_width")).alias("low"), run(F.col("forecast") + F.col("half_width")).alias("high"))


def business_day(date, n):  # noqa: ANN001, ANN201
    """The n-th weekday after a date."""
    days = F.filter(F.sequence(F.date_add(date, 1), F.date_add(date, (n * 2 + 4).cast("int"))), lambda d: ~F.dayofweek(d).isin(1, 7))
    return F.element_at(days, n.cast("int"))


def forecast_steps(returns: DataFrame, horizon: int = 10, p: int = 1, q: int = 1, z: float = 1.96, by: str = "ticker", time: str = "date") -> DataFrame:
    """``by, step, forecast, half_width``: the next log returns of an ARMA fitted to the whole history."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, rows = pdf.sort_values(time)["ret"].to_numpy(float), []
        if len(x) > LEAST_GRID:
            beta, e = hannan_rissanen(x, p, q)
            sd, past, errs = float(e.std()), list(x), list(e)
            for k in range(1, horizon + 1):
                f = float(beta[0] + sum(beta[1 + i] * past[-1 - i] for i in range(p)) + sum(beta[1 + p + i] * errs[-1 - i] for i in range(q)))
                past.append(f)
                errs.append(0.0)
                rows.append((pdf[by].iat[0], k, f, z * sd))
        return pd.DataFrame(rows, columns=[by, "step", "forecast", "half_width"])

    return returns.select(by, time, "ret").groupBy(by).applyInPandas(run, f"{by} string, step int, forecast double, half_width double")


def steady_steps(returns: DataFrame, horizon: int = 10, z: float = 1.96, by: str = "ticker") -> DataFrame:
    """``by, step, forecast, half_width``: the next log returns as the mean of the past, within ``z`` of its deviations."""
    sums = returns.groupBy(by).agg(F.avg("ret").alias("forecast"), (z * F.stddev_samp("ret")).alias("half_width")).where("half_width is not null")
    return sums.select(by, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("step"), "forecast", "half_width")


def residual_diagnostics(returns: DataFrame, p: int = 1, q: int = 1) -> DataFrame:
    """GARCH residuals with the squares whose autocorrelation tells whether clustering is left, and their rolling deviation."""
    g = garch_grid(returns, p, q)
    return g.withColumn("squared", F.pow("std_resid", 2)).withColumn("rolling_sd", rolling(F.stddev_samp, "std_resid", 60, by_date()))
