"""Long series in pieces give what whole series give."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.functions import series
from tickloom.functions.core import rolling
from tickloom.operators import risk as rk
from tickloom.operators import timeseries as ts


@pytest.fixture(scope="module")
def minutes(spark):
    """Minute bars of a long and a short series, with gaps, ties of time and nulls."""
    r, start, rows = np.random.default_rng(4), dt.datetime(2024, 1, 1), []
    for ticker, n in (("LONG", 3000), ("SHORT", 7)):
        at = start
        for i in range(n):
            at += dt.timedelta(minutes=int(r.choice([0, 1, 1, 2, 900])))
            rows.append((ticker, at, i, None if r.random() < 0.03 else float(100 + r.normal())))
    return spark.createDataFrame(rows, "ticker string, date timestamp, id long, close double").repartition(5, "id").cache()


def whole(df):
    return df.toPandas().sort_values(["ticker", "date", "id"]).reset_index(drop=True)


def test_places(minutes):
    got = whole(series.numbered(minutes, ["ticker"], "date", "id", chunk="day"))
    assert (got["_i"] == got.groupby("ticker").cumcount()).all()


@pytest.mark.parametrize("block", [64, 500, None])
def test_rolling_in_blocks(minutes, block):
    columns = {"step": lambda w: F.col("close") - F.lag("close").over(w), "mean": lambda w: rolling(F.avg, "close", 40, w, 20), "sd": lambda w: rolling(F.stddev_samp, "step", 30, w)}
    out = series.rolling_blocks(minutes, columns, 41, time="date", then=["id"], chunk="day", block=block)
    assert out.columns == ["ticker", "date", "id", "close", "step", "mean", "sd"]
    got, want = whole(out), whole(minutes)
    by = want.groupby("ticker")["close"]
    want["mean"] = by.transform(lambda x: x.rolling(40, min_periods=20).mean())
    step = by.diff()
    want["sd"] = step.groupby(want["ticker"]).transform(lambda x: x.rolling(30, min_periods=30).std())
    assert len(got) == len(want)
    # a frame of Spark counts rows at a series' begin that pandas lacks: both need the same number of values
    np.testing.assert_allclose(got["mean"], want["mean"], rtol=1e-9)
    np.testing.assert_allclose(got["sd"], want["sd"], rtol=1e-7)


def test_a_series_takes_many_tasks(minutes):
    out = series.rolling_blocks(minutes.where("ticker = 'LONG'"), {"mean": lambda w: rolling(F.avg, "close", 40, w)}, 40, then=["id"], chunk="day", block=64)
    merging = "spark.sql.adaptive.coalescePartitions.enabled"  # else a test's small partitions become one
    minutes.sparkSession.conf.set(merging, "false")
    try:
        assert out.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        minutes.sparkSession.conf.unset(merging)
    blocks = series.in_blocks(series.numbered(minutes, ["ticker"], "date", "id", chunk="day"), ["ticker"], 40, 64)
    assert blocks.groupBy("ticker", "_block").count().agg(F.max("count")).first()[0] <= 64 + 40
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


@pytest.mark.parametrize(("chunk", "block"), [("day", 300), ("day", None), (None, None)])
def test_ewma_of_whole_series(minutes, chunk, block):
    out = series.ewma(minutes, "close", (1, 2, 5, 16), time="date", then=["id"], chunk=chunk, block=block)
    assert "Python" not in out._jdf.queryExecution().toString()
    got, want = whole(out), whole(minutes)
    for span in (1, 2, 5, 16):
        own = want.groupby("ticker")["close"].transform(lambda x: x.dropna().ewm(span=span, adjust=False).mean())  # noqa: B023
        np.testing.assert_allclose(got[f"ewma_{span}"], own.where(want["close"].notna()), rtol=1e-12)


def test_recurrence_of_any_factor(spark):
    r = np.random.default_rng(8)
    u = r.normal(size=900)
    df = spark.createDataFrame([("A", dt.date(2000, 1, 1) + dt.timedelta(days=i), float(x)) for i, x in enumerate(u)], "ticker string, date date, u double")
    factors = {"none": 0.0, "tiny": 1e-12, "half": 0.5, "slow": 0.97}
    got = series.recurrences(df, {k: (lambda _: F.col("u"), f) for k, f in factors.items()}, chunk="month", block=400).orderBy("date").toPandas()
    for k, f in factors.items():
        y, want = 0.0, []
        for x in u:
            want.append(y := f * y + x)
        np.testing.assert_allclose(got[k], want, rtol=1e-9, atol=1e-12)


def test_native_garch_equals_the_plain_recursion(spark):
    r = np.random.default_rng(3)
    rows = []
    for ticker, n in (("A", 800), ("B", 300), ("FEW", 60)):
        h, e = 1.0, 0.0
        for i in range(n):
            h = 0.1 + 0.15 * e * e + 0.75 * h
            e = r.normal() * h**0.5
            rows.append((ticker, dt.date(2015, 1, 1) + dt.timedelta(days=i), float(e / 100)))
    returns = spark.createDataFrame(rows, "ticker string, date date, ret double")
    got, cut, want = (f.toPandas().sort_values(["ticker", "date"]).reset_index(drop=True) for f in (ts.garch_grid(returns), ts.garch_grid(returns, split="month"), ts._garch_by_ticker(returns, 1, 1, "ticker", "date")))
    pd.testing.assert_frame_equal(got[want.columns], want, rtol=1e-9, check_dtype=False)
    pd.testing.assert_frame_equal(cut[want.columns], want, rtol=1e-9, check_dtype=False)
    assert set(got["ticker"]) == {"A", "B"}
    assert ts._garch_by_ticker(returns, 2, 2, "ticker", "date").count() == 1100


def test_rolling_operators_split_alike(spark):
    r = np.random.default_rng(9)
    days = [dt.date(2010, 1, 1) + dt.timedelta(days=i) for i in range(900)]
    bars = spark.createDataFrame([(t, d, float(50 + r.normal()), float(r.random())) for t in "AB" for d in days], "ticker string, date date, close double, value_rub double")
    index = spark.createDataFrame([(d, float(80 + r.normal())) for d in days], "date date, close double")
    for f in (lambda s: rk.rolling_vol(bars, split=s), lambda s: rk.turnover_mean(bars, split=s), lambda s: rk.rolling_beta_corr(bars, index, split=s)):
        one, many = (f(s).toPandas().sort_values(["ticker", "date"]).reset_index(drop=True) for s in (None, "month"))
        pd.testing.assert_frame_equal(one, many, rtol=1e-8)
