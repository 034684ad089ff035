"""Portfolios by matrices and by improvement, against every portfolio of a fine grid and plain sums."""

import itertools

import numpy as np
import pytest

from tickloom.operators import portfolio as po


def tables(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(60, n)) * rng.uniform(0.5, 2, n) + rng.normal(size=(60, 1))
    c, mu = np.cov(x.T) / 10, rng.uniform(-0.1, 0.3, n)
    names = [f"T{i:03d}" for i in range(n)]
    cov = spark.createDataFrame([(names[i], names[j], float(c[i, j])) for i in range(n) for j in range(i, n)], "a string, b string, cov double")
    return names, c, mu, cov, spark.createDataFrame([(t, float(m)) for t, m in zip(names, mu, strict=True)], "ticker string, mu double")


def test_variances_by_blocks(spark):
    names, c, mu, cov, means = tables(spark, 23)
    w = np.random.default_rng(1).dirichlet(np.ones(23), 9)
    rows = spark.createDataFrame([(p, t, float(w[p, i])) for p in range(9) for i, t in enumerate(names)] + [(50, "unknown", 1.0)], "portfolio long, ticker string, w double")
    for block, chunk in ((256, 512), (5, 4)):
        got = {r.portfolio: r["var"] for r in po.variances(rows, cov, block, chunk).collect()}
        assert got == pytest.approx({p: w[p] @ c @ w[p] for p in range(9)})
    whole = {r.portfolio: (r.ret, r.vol) for r in po.evaluate(rows, means, cov).collect()}
    assert whole[4] == pytest.approx((w[4] @ mu, np.sqrt(w[4] @ c @ w[4])))


def test_improved_portfolios_reach_the_best_of_a_grid(spark):
    names, c, mu, cov, means = tables(spark, 5)
    cuts = [x for x in itertools.product(range(21), repeat=4) if sum(x) <= 40 and max(x) <= 20 and 40 - sum(x) <= 20]
    grid = np.array([(*x, 40 - sum(x)) for x in cuts]) / 40
    tolerances = (0.0, 0.4)
    w = np.zeros((2, 5))
    for r in po.efficient_portfolios(means, cov, tolerances, cap=0.5, gap=1e-3).collect():
        w[r.portfolio, names.index(r.ticker)] = r.w
    assert w.sum(axis=1) == pytest.approx([1, 1]) and (w >= 0).all() and (w <= 0.5 + 1e-9).all()
    for own, t in zip(w, tolerances, strict=True):
        value = lambda x: ((x @ c) * x).sum(axis=-1) / 2 - t * (x @ mu)  # noqa: B023, E731
        assert value(own) <= value(grid).min() + 1e-3 * (own @ c @ own)
    vol = np.sqrt(((grid @ c) * grid).sum(axis=1)).min()
    assert np.sqrt(w[0] @ c @ w[0]) <= 1.01 * vol


def test_few_tickers_and_none(spark):
    names, _, _, cov, means = tables(spark, 2)
    assert {r.ticker: r.w for r in po.efficient_portfolios(means, cov).collect()} == {t: 0.5 for t in names}
    assert po.efficient_portfolios(means.limit(0), cov.limit(0)).count() == 0
