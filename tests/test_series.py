"""Tests of series, orders, recurrences and forecasts against plain NumPy versions."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.functions import linear
from tickloom.operators import timeseries as ts

DAY = dt.date(2020, 1, 1)


@pytest.fixture(scope="module")
def series():
    """Series of several kinds and lengths by ticker."""
    r = np.random.default_rng(11)
    ar = lambda n, a: [v := 0.0] + [v := a * v + e for e in r.normal(0, 0.01, n - 1)]  # noqa: E731, F841
    walk = np.cumsum(r.normal(0, 0.01, 700))
    noise = r.normal(0, 1, 401)
    return {"ar": np.array(ar(500, 0.4)), "walk": walk, "over": np.diff(noise), "short": r.normal(0, 1, 30), "least": r.normal(0, 1, 31), "grid": np.array(ar(61, 0.2)), "flat": np.full(50, 0.5), "clustered": np.array(ar(900, 0.1)) * (1 + 3 * (np.arange(900) % 200 < 40))}


@pytest.fixture(scope="module")
def rows(spark, series):
    data = [(k, DAY + dt.timedelta(days=i), float(x)) for k, xs in series.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(data, "ticker string, date date, ret double").repartition(3, "date").cache()


def residuals(z, y):
    beta = np.linalg.lstsq(z, y, rcond=None)[0]
    return beta, y - z @ beta


def lagged(x, lags, first):
    return np.column_stack([x[first - k : len(x) - k] for k in range(1, lags + 1)]) if lags else np.empty((len(x) - first, 0))


def plain_adf(x):
    d, n = np.diff(x), len(x)
    most = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)

    def fit(lags, first):
        z = np.column_stack([np.ones(len(d) - first), x[first:-1], lagged(d, lags, first)])
        beta, e = residuals(z, d[first:])
        s2 = e @ e / (len(e) - z.shape[1])
        return len(e) * math.log(e @ e / len(e)) + 2 * z.shape[1], beta[1] / math.sqrt(s2 * np.linalg.inv(z.T @ z)[1, 1])

    lags = min(range(most + 1), key=lambda p: fit(p, most)[0])
    return fit(lags, lags)[1], lags


def plain_kpss(x):
    n, e = len(x), x - x.mean()
    s0, s1 = e @ e / n, 0.0
    for k in range(1, int(n ** (2 / 9)) + 1):
        c = e[k:] @ e[:-k] / (n / 2)
        s0, s1 = s0 + c, s1 + k * c
    lags = min(int(1.1447 * ((s1 / s0) ** 2) ** (1 / 3) * n ** (1 / 3)), n - 1)
    v = e @ e / n + 2 / n * sum((1 - k / (lags + 1)) * (e[k:] @ e[:-k]) for k in range(1, lags + 1))
    stat = (np.cumsum(e) ** 2).sum() / n**2 / v
    return stat, lags, float(np.interp(stat, [0.347, 0.463, 0.574, 0.739], [0.1, 0.05, 0.025, 0.01]))


def test_normal_cdf(spark):
    xs = [-40.0, -20.0, -8.5, -7.1, -7.0, -2.86, -1.0, 0.0, 0.5, 3.0, 7.2, 12.0, None]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(linear.normal_cdf(F.col("x"))).collect()]
    for x, y in zip(xs, got, strict=True):
        assert y is None if x is None else y == pytest.approx(0.5 * math.erfc(-x / math.sqrt(2)), rel=1e-6, abs=1e-14)


def test_stationarity_against_numpy(rows, series):
    got = {r.ticker: r for r in ts.stationarity(rows).collect()}
    assert set(got) == set(series)
    for k, x in series.items():
        r = got[k]
        assert r.n == len(x)
        if k in ("short", "flat"):
            assert (r.adf, r.adf_lags, r.adf_p, r.kpss, r.kpss_p) == (None,) * 5
            continue
        stat, lags = plain_adf(x)
        assert r.adf_lags == lags and r.adf == pytest.approx(stat, abs=1e-6)
        level, band, p = plain_kpss(x)
        assert r.kpss_lags == band and r.kpss == pytest.approx(level, abs=1e-6) and r.kpss_p == pytest.approx(p, abs=1e-6)
    # known quantiles of the distribution with a constant
    assert got["ar"].adf_p < 1e-6 and got["walk"].adf_p > 0.05 and got["walk"].kpss_p == 0.01 and got["ar"].kpss_p > 0.05


@pytest.mark.parametrize(("stat", "p"), [(-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10), (-0.44, 0.90), (0.60, 0.99)])
def test_unit_root_p_values_at_tabled_points(spark, stat, p):
    part = ts.ADF_SMALL if stat <= ts.ADF_BORDER else ts.ADF_LARGE
    got = spark.range(1).select(linear.normal_cdf(linear.polynomial(F.lit(stat), part))).first()[0]
    assert got == pytest.approx(p, abs=0.006)


def test_arch_lm_against_numpy(rows, series):
    got = {r.ticker: r for r in ts.arch_lm(rows).collect()}
    for k, x in series.items():
        y = x**2
        if len(x) <= 30 or k == "flat":
            assert got[k].arch_lm is None or k == "flat" and got[k].arch_lm == pytest.approx(0, abs=1)
            continue
        _, e = residuals(np.column_stack([np.ones(len(y) - 10), lagged(y, 10, 10)]), y[10:])
        lm = (len(y) - 10) * (1 - e @ e / ((y[10:] - y[10:].mean()) ** 2).sum())
        assert got[k].arch_lm == pytest.approx(lm, rel=1e-8)
        assert 0 <= got[k].arch_lm_p <= 1
    assert got["clustered"].arch_lm_p < 1e-6 < got["ar"].arch_lm_p


def test_orders_against_least_squares(rows, series):
    got = {(r.ticker, r.p, r.d, r.q): (r.aic, r.bic) for r in ts.arma_grid(rows).collect()}
    long, most = ts.INNOVATION_LAGS, ts.MOST_ORDER
    assert {k[0] for k in got} == {k for k, x in series.items() if len(x) > 60} and all(len([1 for k in got if k[0] == t]) == 30 for t in {k[0] for k in got})
    for (k, p, d, q), (aic, bic) in got.items():
        x, first = np.diff(series[k], d), long + most
        beta, _ = residuals(np.column_stack([np.ones(len(x) - first), lagged(x, long, first)]), x[first:])
        e = x.copy()
        e[long:] = x[long:] - np.column_stack([np.ones(len(x) - long), lagged(x, long, long)]) @ beta
        z = np.column_stack([np.ones(len(x) - first), lagged(x, p, first), lagged(e, q, first)])
        _, u = residuals(z, x[first:])
        ll = len(u) * math.log(u @ u / len(u))
        assert aic == pytest.approx(ll + 2 * (p + q + 1), rel=1e-7, abs=1e-5) and bic == pytest.approx(ll + math.log(len(u)) * (p + q + 1), rel=1e-7, abs=1e-5)


def refits(x, p, q, train, refit):
    """Forecasts from least squares on the whole past at every refit."""
    first, out, beta, e = int(len(x) * train), [], None, None
    for i in range(first, len(x)):
        if (i - first) % refit == 0:
            beta, res = ts.hannan_rissanen(x[:i], p, q)
            e = list(res)
        guess = beta[0] + sum(beta[1 + k] * x[i - 1 - k] for k in range(p)) + sum(beta[1 + p + k] * e[-1 - k] for k in range(q))
        out.append(guess)
        e.append(x[i] - guess)
    return out


@pytest.mark.parametrize(("p", "q", "refit"), [(1, 1, 20), (3, 2, 7), (2, 0, 1), (0, 1, 50)])
def test_forecasts_equal_refits(rows, series, p, q, refit):
    got = {}
    for r in ts.walk_forward_forecast(rows, p, q, refit=refit).orderBy("date").collect():
        got.setdefault(r.ticker, []).append((r.actual, r.forecast, r.error))
    assert set(got) == {k for k, x in series.items() if len(x) >= 100}
    for k, own in got.items():
        want = refits(series[k], p, q, 0.8, refit)
        assert [f for _, f, _ in own] == pytest.approx(want, rel=1e-7, abs=1e-8)
        assert [a for a, _, _ in own] == pytest.approx(series[k][int(len(series[k]) * 0.8) :])
        assert all(e == pytest.approx(a - f) for a, f, e in own)


def test_fit_recovers_known_coefficients():
    r = np.random.default_rng(2)
    e, x = r.normal(0, 1, 20_000), np.zeros(20_000)
    for t in range(1, len(x)):
        x[t] = 0.5 + 0.6 * x[t - 1] + e[t] + 0.3 * e[t - 1]
    beta, last = ts.GrowingArma(x, 1, 1).advance(len(x))
    assert beta == pytest.approx([0.5, 0.6, 0.3], abs=0.05) and last == pytest.approx([e[-1]], abs=0.1)


def test_long_or_cash_and_errors(spark):
    data = [("A", DAY + dt.timedelta(days=i), a, f, a - f) for i, (a, f) in enumerate([(0.1, 0.05), (-0.2, 0.01), (0.3, -0.1), (0.05, 0.0), (0.02, 0.2)])]
    forecasts = spark.createDataFrame(data, "ticker string, date date, actual double, forecast double, error double")
    r = ts.long_cash(forecasts).first()
    own = np.array([0.1, -0.2, 0.0, 0.0, 0.02])
    assert r.total_pct == pytest.approx((math.exp(-0.08) - 1) * 100) and r.hold_pct == pytest.approx((math.exp(0.27) - 1) * 100)
    assert r.sharpe == pytest.approx(own.mean() / own.std(ddof=1) * math.sqrt(252)) and r.long_pct == pytest.approx(60)
    e = np.array([x[-1] for x in data])
    errors = ts.forecast_errors(forecasts).first()
    assert (errors.n, errors.rmse, errors.mae) == (5, pytest.approx(math.sqrt((e**2).mean())), pytest.approx(abs(e).mean()))
    # five forecasts: the last one each
    assert [x.rmse for x in ts.rolling_rmse(forecasts).orderBy("date").collect()] == pytest.approx(list(abs(e)))


def test_forward_path_of_steps(spark):
    bars = spark.createDataFrame([("A", dt.date(2024, 5, 30), 90.0), ("A", dt.date(2024, 5, 31), 100.0)], "ticker string, date date, close double")
    steps = spark.createDataFrame([("A", 1, 0.01, 0.02), ("A", 2, -0.02, 0.02)], "ticker string, step int, forecast double, half_width double")
    got = [tuple(r)[1:] for r in ts.forward_path(bars, steps).orderBy("date").collect()]
    assert got == [(dt.date(2024, 6, 3), *map(pytest.approx, (100 * math.exp(0.01), 100 * math.exp(-0.01), 100 * math.exp(0.03)))), (dt.date(2024, 6, 4), *map(pytest.approx, (100 * math.exp(-0.01), 100 * math.exp(-0.05), 100 * math.exp(0.03))))]


def test_steps_of_a_known_process(rows, series):
    got = [r.forecast for r in ts.forecast_steps(rows.where("ticker = 'ar'"), 5, 1, 0).orderBy("step").collect()]
    x = series["ar"]
    beta, _ = residuals(np.column_stack([np.ones(len(x) - 1), x[:-1]]), x[1:])
    want, v = [], x[-1]
    for _ in range(5):
        want.append(v := beta[0] + beta[1] * v)
    assert got == pytest.approx(want)
