"""Exact percentiles against NumPy."""

import numpy as np
import pytest

from tickloom.functions.quantiles import exact_percentiles

PS = (0.0, 0.01, 0.25, 0.5, 0.777, 0.99, 1.0)


@pytest.fixture(scope="module")
def groups():
    r = np.random.default_rng(12)
    return {
        "normal": r.normal(size=3000), "ties": np.repeat([1.0, 2.0, 3.0], [700, 900, 400]), "one": np.array([5.0]), "two": np.array([1.0, 4.0]), "far": np.concatenate([r.random(900), [1e300, -1e300]]),
        "dense": 1 + r.random(2000) * 1e-13, "infinite": np.concatenate([r.random(500), [np.inf, -np.inf]]), "skewed": np.exp(r.normal(0, 8, 2000)),
    }


@pytest.mark.parametrize(("bins", "gather"), [(4, 20), (1024, 16_384)])
def test_against_numpy(spark, groups, bins, gather):
    data = [(k, float(x)) for k, xs in groups.items() for x in xs] + [("normal", None), ("normal", float("nan")), ("none", None), (None, 1.0)]
    df = spark.createDataFrame(data, "g string, x double").repartition(4).cache()
    got = {r.g: r.percentiles for r in exact_percentiles(df, "x", PS, ["g"], bins, gather).collect()}
    assert set(got) == set(groups)
    for k, xs in groups.items():
        assert got[k] == pytest.approx([float(np.quantile(xs, p)) if k != "infinite" or 0 < p < 1 else (-np.inf if p == 0 else np.inf) for p in PS], rel=1e-12, abs=1e-15), k


def test_empty(spark):
    assert exact_percentiles(spark.createDataFrame([], "g string, x double"), "x", PS, ["g"]).count() == 0
