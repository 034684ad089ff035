"""Hand-computed cases of the operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions import core, series
from tickloom.operators import backtest as bt
from tickloom.operators import bonds as bd
from tickloom.operators import corporate_actions as ca
from tickloom.operators import performance as pf
from tickloom.operators import portfolio as po
from tickloom.operators import risk as rk
from tickloom.operators import timeseries as ts
from tickloom.sources import market as mk


def day(n, month=1):
    return dt.date(2024, month, n)


@pytest.fixture
def bars(spark):
    def make(closes, ticker="A", start=2, **more):
        rows = [(ticker, day(start + i), float(c), 10.0, *[float(v[i]) for v in more.values()]) for i, c in enumerate(closes)]
        return spark.createDataFrame(rows, ", ".join(["ticker string, date date, close double, volume double", *[f"{k} double" for k in more]]))

    return make


def splits(spark, *rows):
    return spark.createDataFrame([(t, d, float(r), k) for t, d, r, k in rows], "ticker string, date date, ratio double, kind string")


def dividends(spark, *rows):
    return spark.createDataFrame([("A", d, float(v)) for d, v in rows], "ticker string, closing_date date, dividend_value double")


def column(df, name):
    return [r[name] for r in df.orderBy("ticker", "date").collect()]


@pytest.mark.parametrize(("closes", "divs", "events", "expected"), [
    ([100] * 4, [(4, 10)], [], [90, 90, 90, 100]),
    ([100] * 4, [(3, 10), (4, 10)], [], [81, 81, 90, 100]),
    ([100] * 4, [(1, 10)], [], [100] * 4),
    ([1000, 1010, 101, 102], [], [(4, 10, "price")], [100, 101, 101, 102]),
    ([1000, 1010, 101, 102], [(3, 101)], [(4, 10, "price")], [90, 90.9, 101, 102]),
    ([0.02, 0.02, 100, 101], [(3, 7)], [(4, 0.0002, "price")], [93, 93, 100, 101]),
])
def test_adjusted_close(spark, bars, closes, divs, events, expected):
    out = ca.adjusted_close(bars(closes), dividends(spark, *[(day(d), v) for d, v in divs]), splits(spark, *[("A", day(d), r, k) for d, r, k in events]))
    assert column(out, "adj_close") == pytest.approx(expected)
    assert column(out, "close") == pytest.approx(closes)


def test_split_changes_prices_and_volume(spark, bars):
    out = ca.adjust_for_splits(bars([1000, 1010, 101, 102], waprice=[990, 1000, 100.5, 101.5]), splits(spark, ("A", day(4), 10, "price")))
    assert column(out, "waprice") == pytest.approx([99, 100, 100.5, 101.5])
    assert column(out, "volume") == pytest.approx([100, 100, 10, 10])


@pytest.mark.parametrize(("closes", "expected"), [([1000, 1010, 101], [100, 101, 101]), ([100, 101, 102], [100, 101, 102])])
def test_auto_split_needs_the_jump(spark, bars, closes, expected):
    assert column(ca.adjust_for_splits(bars(closes), splits(spark, ("A", day(4), 10, "auto"))), "close") == pytest.approx(expected)


def test_reverse_split(spark, bars):
    assert column(ca.adjust_for_splits(bars([0.01, 1.0]), splits(spark, ("A", day(3), 0.01, "price"))), "close") == pytest.approx([1.0, 1.0])


def test_splits_in_any_order(spark, bars):
    events = [("A", day(3), 2, "price"), ("A", day(4), 5, "price")]
    one, two = (column(ca.adjust_for_splits(bars([100, 100, 100, 100]), splits(spark, *e)), "close") for e in (events, events[::-1]))
    assert one == two == pytest.approx([10, 20, 100, 100])


def test_split_registry(spark):
    payload = '{"A": [{"date": "2024-01-20", "ratio": 10, "kind": "split"}], "B": [{"date": "2024-01-20", "ratio": 100, "kind": "reverse"}]}'
    own = spark.createDataFrame([("A", day(5), 10.0)], "ticker string, date date, ratio double")
    out = {r.ticker: (r.ratio, r.kind) for r in mk.load_splits(own, spark.createDataFrame([(payload,)], "payload string")).collect()}
    assert out == {"A": (10.0, "price"), "B": (0.01, "auto")}


def test_market_cap(spark, bars):
    shares = spark.createDataFrame([("A", day(5), 1000.0), ("A", day(8), 2000.0)], "ticker string, date date, shares double")
    rows = bars([1, 1, 1, 1], start=3).withColumn("date", F.when(F.col("date") == day(4), day(6)).when(F.col("date") == day(5), day(8)).when(F.col("date") == day(6), day(10)).otherwise(F.col("date")))
    assert column(ca.market_cap(rows, shares, splits(spark)), "shares") == [1000, 1000, 2000, 2000]
    flat = spark.createDataFrame([("A", day(2), 1000.0)], "ticker string, date date, shares double")
    assert column(ca.market_cap(bars([100, 100]), flat, splits(spark, ("A", day(3), 100, "auto"))), "market_cap") == pytest.approx([1e7, 1e7])
    many = spark.createDataFrame([("A", day(2), 100000.0)], "ticker string, date date, shares double")
    assert column(ca.market_cap(bars([100, 100]), many, splits(spark, ("A", day(3), 100, "shares"))), "market_cap") == pytest.approx([1e5, 1e5])


def test_renames(spark, bars):
    chain = spark.createDataFrame([("A", "B", day(4)), ("B", "C", day(6))], "old string, new string, date date")
    rows = bars([1, 2, 3], "A", 2).unionByName(bars([4, 5, 6], "B", 4)).unionByName(bars([7, 8], "C", 6))
    out = ca.apply_renames(rows, chain)
    assert {r.ticker for r in out.collect()} == {"C"}
    assert [r.source_ticker for r in out.orderBy("date", "source_ticker").collect()] == ["A", "A", "B", "B", "C", "C"]


def test_policy_rate(spark):
    rates = spark.createDataFrame([(dt.date(2024, 2, 15), 12.0), (dt.date(2024, 4, 10), 24.0)], "date date, rate double")
    months = spark.createDataFrame([(dt.date(2024, m, d),) for m, d in ((1, 31), (2, 29), (3, 31), (4, 30))], "date date")
    assert [r.rf for r in ca.risk_free_monthly(months, rates).orderBy("date").collect()] == pytest.approx([0.01, 0.01, 0.01, 0.02])
    assert [r.rf for r in ca.risk_free_monthly(months, rates.limit(0)).collect()] == [0.0] * 4


def test_main_board(spark):
    rows = spark.createDataFrame([("A", day(3), "X", 100.0, 99.0), ("A", day(3), "Y", 1000.0, 100.5), ("A", day(4), "X", None, None), ("A", day(4), "Y", 5.0, 7.0)], "ticker string, date date, boardid string, value_rub double, close double")
    assert column(mk.main_board(rows), "close") == [100.5]
    assert column(mk.main_board(rows, nulls_win=False), "close") == [100.5, 7.0]


def test_upsert_takes_the_newer(bars):
    out = mk.upsert(bars([100, 101, 102]), bars([999, 103, 104], start=4))
    assert column(out, "close") == [100, 101, 999, 103, 104]


@pytest.mark.parametrize("payload", ['{"t": {"columns": ["SECID", "N"], "data": [["a", 1], ["b", null]]}}', '{"t": [["SECID", "N"], ["a", 1], ["b", null]]}', '{"t": [{"SECID": "a", "N": 1}, {"SECID": "b"}]}'])
def test_three_table_shapes(spark, payload):
    out = mk.parse_tables(spark.createDataFrame([(payload,)], "payload string"), "t", ["SECID", "N"])
    assert [(r.secid, r.n) for r in out.orderBy("row_pos").collect()] == [("a", "1"), ("b", None)]


def test_dates_are_checked():
    assert mk.check_dates("2024-01-01", "2024-01-02")
    for bad in (("2024-01-03", "2024-01-02"), ("x", "2024-01-02")):
        with pytest.raises(ValueError):
            mk.check_dates(*bad)


def test_stored_table(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    assert mk.write_bars(bars([1, 2, 3]), path)
    assert not mk.write_bars(bars([1]).limit(0), str(tmp_path / "none"))
    assert column(mk.read_bars(spark, path, ["a"], "2024-01-03", "2024-01-03"), "close") == [2]
    assert mk.read_all(spark, path).count() == 3
    with pytest.raises(FileNotFoundError):
        mk.read_one(spark, path, "ticker", "Z", "ticker string, date date, close double")


def test_a_replaced_table_can_be_read_meanwhile(spark, bars, tmp_path):
    """The table may be read by the job that replaces it; a reader that has begun still finds its rows; a job that fails changes nothing."""
    path = str(tmp_path / "bars")
    mk.write_bars(bars([1, 2, 3]), path)
    begun = mk.read_bars(spark, path)
    mk.write_bars(mk.upsert(mk.read_bars(spark, path), bars([9], start=3)), path)
    assert column(begun, "close") == [1, 2, 3] and column(mk.read_bars(spark, path), "close") == [1, 9, 3]
    broken = mk.read_bars(spark, path).withColumn("close", F.when(F.col("close") > 0, F.raise_error(F.lit("broken"))).cast("double"))
    with pytest.raises(Exception, match="broken"):
        mk.write_bars(broken.where("close is null or close > -1"), path)
    assert column(mk.read_bars(spark, path), "close") == [1, 9, 3]
    mk.write_bars(bars([5]), path)
    assert sorted(p.name[:2] for p in (tmp_path / "bars").iterdir() if p.name.startswith("v-")) == ["v-", "v-"]


def test_a_failing_security_keeps_its_rows(spark, bars):
    stored = bars([1, 2], "A").unionByName(bars([3, 4], "B")).drop("volume")
    landed = spark.createDataFrame([("A", "2024-01-03", "n/a"), ("A", "2024-01-04", "7"), ("B", "2024-01-03", "9"), ("B", "2024-01-04", None), ("C", "2024-01-03", "5"), ("D", "x", "5")], "ticker string, date string, close string")
    out, failed = mk.update_all(stored, landed)
    rows = {(r.ticker, r.date.day): r.close for r in out.collect()}
    assert rows == {("A", 2): 1, ("A", 3): 2, ("B", 2): 3, ("B", 3): 9, ("B", 4): None, ("C", 3): 5}
    assert {r.ticker for r in failed.collect()} == {"A", "D"}
    again = {(r.ticker, r.date.day): r.close for r in mk.update_all(stored, landed, rebuild=True)[0].collect()}
    assert again == {("A", 2): 1, ("A", 3): 2, ("B", 3): 9, ("B", 4): None, ("C", 3): 5}


def test_bond_payloads(spark):
    docs = [('{"securities": {"columns": ["SECID", "SHORTNAME", "BOARDID", "FACEVALUE", "COUPONPERCENT", "MATDATE"], "data": [["a", "A", "TQCB", 1000, 7.5, "2030-01-31"], ["b", "B", "TQOB", "x", null, "0000-00-00"]]}}',), ('{"securities": [{"SECID": "c", "BOARDID": "TQCB"}]}',)]
    payloads = spark.createDataFrame(docs, "payload string")
    assert [(r.secid, r.facevalue, r.couponpercent, r.matdate) for r in mk.bond_params(payloads).orderBy("secid").collect()] == [("a", 1000.0, 7.5, dt.date(2030, 1, 31)), ("b", None, None, None), ("c", None, None, None)]
    assert [(r.secid, r.shortname) for r in mk.bond_list(payloads).orderBy("secid").collect()] == [("a", "A"), ("c", None)]


def test_yields_of_all_ways(spark):
    """Steps as projections and as one expression agree, and discounting at the yield gives back the price."""
    rows = [(p, c, y) for p in (5.0, 60.0, 99.0, 100.0, 140.0, 400.0) for c in (0.0, 0.5, 8.0, 30.0) for y in (0.4, 0.6, 3.2, 12.0, 40.0)]
    df = spark.createDataFrame(rows, "p double, c double, y double").withColumn("f", F.lit(100.0))
    out = bd.with_yield(df, "p", "f", "c", "y").withColumn("again", bd.ytm(F.col("p"), F.col("f"), F.col("c"), F.col("y"))).collect()
    for r in out:
        n, own = int(r.y * 2), r.c / 2
        assert r.ytm == pytest.approx(r.again, abs=1e-9)
        if n and -50 < r.ytm < 500:
            assert sum(own / (1 + r.ytm / 200) ** t for t in range(1, n + 1)) + 100 / (1 + r.ytm / 200) ** n == pytest.approx(r.p, rel=1e-9)
        elif n:
            assert r.ytm in (-50.0, 500.0)


def test_long_rename_chains(spark):
    links = spark.createDataFrame([(f"T{i}", f"T{i + 1}", dt.date(2000, 1, 1) + dt.timedelta(i)) for i in range(90)], "old string, new string, date date")
    assert {r.final for r in ca.rename_chains(links).collect()} == {"T90"}


def test_missing_registry_is_empty(spark, tmp_path):
    assert mk.registry(spark, str(tmp_path / "none.csv"), "old string, new string, date date").count() == 0


@pytest.mark.parametrize(("price", "coupon", "years", "low", "high"), [(100, 10, 5, 9.999, 10.001), (105, 10, 5, 0, 10), (95, 10, 5, 10, 99), (100, 8, 30, 7.999, 8.001), (100, 8, 0, 0, 0)])
def test_yield(spark, price, coupon, years, low, high):
    for face in (1, 1000, 100000):
        y = spark.range(1).select(bd.ytm(F.lit(price * face / 100.0), F.lit(float(face)), F.lit(float(coupon)), F.lit(float(years)))).first()[0]
        assert low <= y <= high


def test_zero_coupon_duration(spark):
    assert spark.range(1).select(bd.modified_duration(F.lit(1000.0), F.lit(0.0), F.lit(1.0), F.lit(10.0))).first()[0] == pytest.approx(1 / 1.05)


def test_period_needs_two_bars(spark, bars):
    rows = bars([100, 110], "A").unionByName(bars([5], "B")).unionByName(bars([0, 5], "C"))
    out = pf.period_performance(rows, "all").collect()
    assert [(r.ticker, round(r.price_pct, 9)) for r in out] == [("A", 10.0)]


def test_pct_rank_averages_ties(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 2.0), (1, None)], "m int, v double")
    assert sorted(r.p for r in df.select(core.pct_rank_avg(F.col("v"), "m").alias("p")).collect() if r.p is not None) == pytest.approx([1 / 3, 2.5 / 3, 2.5 / 3])


def test_moments_match_pandas(spark):
    import pandas as pd

    xs = [1.0, 2.0, 2.5, 7.0, 11.0]
    row = spark.createDataFrame([(x,) for x in xs], "v double").agg(core.skew_adjusted(F.col("v")).alias("s"), core.kurtosis_adjusted(F.col("v")).alias("k")).first()
    assert (row.s, row.k) == pytest.approx((pd.Series(xs).skew(), pd.Series(xs).kurt()))


def test_ewma_matches_pandas(spark, bars):
    import pandas as pd

    xs = [1, 4, 2, 8, 5, 7]
    out = series.ewma(bars(xs), "close", (3,))
    assert column(out, "ewma_3") == pytest.approx(list(pd.Series(xs).ewm(span=3, adjust=False).mean()))
    assert bars(xs).agg(core.ewma_last(F.col("close"), F.col("date"), 3)).first()[0] == pytest.approx(pd.Series(xs).ewm(span=3, adjust=False).mean().iloc[-1])


def test_holding_and_backtest(spark):
    months = spark.createDataFrame([(dt.date(2024, m, 28), m) for m in range(1, 5)], "month date, ord int")
    w = spark.createDataFrame([("A", 1, 1.0), ("B", 2, 1.0)], "ticker string, ord int, weight double")
    held = bt.apply_holding(w, 2, months)
    assert {(r.ticker, r.ord): r.weight for r in held.collect()} == {("A", 1): 0.5, ("A", 2): 0.5, ("B", 2): 0.5, ("B", 3): 0.5}
    rets = spark.createDataFrame([("A", 2, 0.1), ("A", 3, -1.5), ("B", 3, None)], "ticker string, ord int, ret double")
    out = {r.ord: r for r in bt.backtest_monthly(rets, held, months, 10.0).collect()}
    assert out[2].ret_gross == pytest.approx(0.05) and out[3].ret_gross == 0 and out[1].turnover == pytest.approx(0.25)
    assert out[1].ret_net == pytest.approx(-0.25 * 10 / 1e4)
    assert {r.ord: r.ret_gross for r in bt.backtest_monthly(rets, held, months, missing="penalize").collect()}[3] == pytest.approx(-1.0)


def test_legs_sum_to_one_and_short_wins(spark):
    rows = [(dt.date(2024, 1, 31), 1, f"T{i}", float(i), 0.1 * (i + 1), 1.0) for i in range(10)]
    sig = spark.createDataFrame(rows, "month date, ord int, ticker string, mom double, vol double, turnover double")
    for how in ("equal", "inverse_vol"):
        w = [r.weight for r in bt.rebalance_weights(sig, q=0.3, long_short=True, weighting=how).collect()]
        assert sum(x for x in w if x > 0) == pytest.approx(1) and sum(x for x in w if x < 0) == pytest.approx(-1)
    one = bt.rebalance_weights(sig.limit(1), q=0.3, long_short=True).collect()
    assert [r.weight for r in one] == [-1.0]


def test_covariance_and_shrinkage(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 3)) * 0.01
    rows = [(f"T{j}", dt.date(2024, 1, 1) + dt.timedelta(i), float(x[i, j])) for i in range(60) for j in range(3)]
    rets = spark.createDataFrame(rows, "ticker string, date date, ret double")
    cov = {(r.a, r.b): r["cov"] for r in po.covariances(rets).collect()}
    assert cov["T0", "T1"] == pytest.approx(np.cov(x.T)[0, 1] * 252)
    lw = po.ledoit_wolf(rets).collect()
    assert 0 <= lw[0].shrinkage <= 1
    w = po.candidate_portfolios(rets.select("ticker"), 50, cap=0.5).groupBy("portfolio").agg(F.sum("w").alias("s"), F.max("w").alias("m")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in w) and all(r.m <= 0.5 + 1e-9 for r in w)


def test_chi_square_tail(spark):
    assert spark.range(1).select(core.chi2_sf_even(F.lit(18.307038), 10)).first()[0] == pytest.approx(0.05, abs=1e-6)


def test_forecast_on_a_known_process(spark):
    import numpy as np

    rng, x = np.random.default_rng(3), [0.0]
    for _ in range(399):
        x.append(0.7 * x[-1] + rng.normal() * 0.01)
    rows = spark.createDataFrame([("A", dt.date(2020, 1, 1) + dt.timedelta(i), float(v)) for i, v in enumerate(x)], "ticker string, date date, ret double")
    acf = {r.lag: r.acf for r in ts.acf(rows, lags=5).collect()}
    assert acf[1] == pytest.approx(0.7, abs=0.12)
    assert {r.lag: r.pacf for r in ts.pacf(ts.acf(rows, lags=5)).collect()}[2] == pytest.approx(0, abs=0.15)
    err = ts.forecast_errors(ts.walk_forward_forecast(rows, train=0.8)).first()
    assert err.n == 80 and err.rmse < 0.013
    assert ts.stationarity(rows).first().adf_p < 0.01
    assert {(r.p, r.q) for r in ts.arma_grid(rows, 2).where("rank = 1").collect()} & {(1, 0), (1, 1), (2, 0), (0, 2), (1, 2), (2, 1), (2, 2)}


def test_business_days(spark):
    friday = F.lit("2024-01-05").cast("date")
    assert [spark.range(1).select(ts.business_day(friday, F.lit(n))).first()[0] for n in (1, 2, 6)] == [dt.date(2024, 1, 8), dt.date(2024, 1, 9), dt.date(2024, 1, 15)]


def test_empty_tables(spark, bars):
    none = bars([1]).limit(0)
    assert ca.adjust_for_splits(none, splits(spark)).count() == 0
    assert pf.period_performance(none, "1m").count() == 0
    assert rk.return_stats(none).count() == 0


def test_yields_are_compiled(spark):
    """No method of the generated code is longer than the 8,000 bytes that the virtual machine compiles; odd prices and terms."""
    import contextlib
    import io
    import re

    prices = spark.createDataFrame([("a", dt.date(2000, 1, 1), p) for p in (None, -5.0, 0.0, 90.0)] + [(s, dt.date(2000, 1, 1), 90.0) for s in "bcd"], "secid string, tradedate date, close double")
    params = spark.createDataFrame([("a", 1000.0, 8.0, dt.date(2005, 1, 1)), ("b", None, None, dt.date(2005, 1, 1)), ("c", 1000.0, 8.0, None)], "secid string, facevalue double, couponpercent double, matdate date")
    out = bd.bond_metrics(prices, params)
    got = [(r.secid, r.close, *(x if x is None else round(x, 3) for x in (r.ytm, r.duration))) for r in out.orderBy("secid", "close").collect()]
    assert [g[:3] for g in got[:3]] == [("a", None, None), ("a", -5.0, 500.0), ("a", 0.0, 500.0)] and got[0][3] is None
    rate = 1 + got[3][2] / 200
    assert sum(40 / rate**t for t in range(1, 11)) + 1000 / rate**10 == pytest.approx(900, abs=0.1)
    assert 1000 / (1 + got[4][2] / 200) ** 10 == pytest.approx(900, abs=0.1) and [g[2:] for g in got[5:]] == [(None, None)] * 2
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with contextlib.redirect_stdout(io.StringIO()) as text:
            bd.bond_metrics(prices, params).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text.getvalue())]
    assert sizes and max(sizes) < 8000
