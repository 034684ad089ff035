"""Sources on files as they land."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from tickloom.operators import portfolio as po
from tickloom.sources import market as mk


def test_dividends_from_one_file_a_ticker(spark, tmp_path):
    (tmp_path / "AAA.csv").write_text("closing_date,dividend_value\n2020-05-01,1.5\n2021-05-01,0\n,2\n")
    (tmp_path / "BB.B.csv").write_text("closing_date,dividend_value\n2020-06-01,3\n2020-07-01,\n")
    (tmp_path / "B2.csv").write_text("closing_date,dividend_value\n2020-06-01,3\n2020-07-01,-1\n")
    got = sorted((r.ticker, str(r.closing_date), r.dividend_value) for r in mk.load_dividends(spark, str(tmp_path)).collect())
    assert got == [("AAA", "2020-05-01", 1.5), ("B2", "2020-06-01", 3.0), ("BB.B", "2020-06-01", 3.0)]


def test_complete_days_of_a_daily_panel(spark):
    """The panel keeps the days on which every ticker has a price, whatever their spacing."""
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(30)]
    rows = [(t, d, 10.0 + i) for t in "ABC" for i, d in enumerate(days) if not (t == "B" and i % 7 == 3) and not (t == "C" and i in (0, 29))]
    rows.append(("B", days[3], None))
    bars = spark.createDataFrame(rows, "ticker string, date date, close double")
    got = po.complete_case(bars)
    want = {d for i, d in enumerate(days) if i % 7 != 3 and i not in (0, 29)}
    assert {r.date for r in got.collect()} == want and got.count() == 3 * len(want)
    assert {r.date for r in po.complete_case(bars, bars.where("ticker <> 'C'")).collect()} == {d for i, d in enumerate(days) if i % 7 != 3}
    returns = po.panel_returns(got).where("ticker = 'A'").orderBy("date").select(F.round("ret", 9)).collect()
    prices = [10.0 + i for i, d in enumerate(days) if d in want]
    assert [r[0] for r in returns] == [round(b / a - 1, 9) for a, b in zip(prices, prices[1:])]


@pytest.mark.parametrize("shape", ["object", "lists", "dicts"])
def test_a_long_table_is_parsed_once(spark, shape):
    """3,000 rows in one document: parsed again for each row, they take minutes."""
    heads = ["SECID", "SHORTNAME", "BOARDID", "FACEVALUE", "COUPONPERCENT", "MATDATE"]
    data = [[f"b{i}", f"bond {i}", "TQCB" if i % 3 else "TQOB", "1000", str(i % 13), "2030-01-31"] for i in range(3000)]
    table = {"object": {"columns": heads, "data": data}, "lists": [heads, *data], "dicts": [dict(zip(heads, r)) for r in data]}[shape]
    payloads = spark.createDataFrame([(json.dumps({"securities": table}),), (None,), ("{}",), ('{"securities": {"columns": ["SECID"], "data": null}}',)], "payload string")
    start = time.perf_counter()
    rows = mk.parse_tables(payloads, "securities", ["SECID", "MATDATE", "ABSENT"]).collect()
    assert sorted((r.row_pos, r.secid, r.matdate, r.absent) for r in rows) == [(i, f"b{i}", "2030-01-31", None) for i in range(3000)]
    assert {(r.secid, r.couponpercent) for r in mk.bond_params(payloads).collect()} == {(f"b{i}", float(i % 13)) for i in range(3000)}
    assert mk.bond_list(payloads).count() == 2000
    assert time.perf_counter() - start < 60


def test_a_long_history_keeps_its_security(spark):
    """The columns kept beside a document of 3,000 rows, as a bond's history has them."""
    data = [[str(dt.date(2010, 1, 1) + dt.timedelta(days=i)), str(100 + i / 8)] for i in range(3000)]
    docs = spark.createDataFrame([(s, json.dumps({"history": {"columns": ["TRADEDATE", "CLOSE"], "data": data}})) for s in ("B1", "B2")], "secid string, payload string")
    start = time.perf_counter()
    rows = mk.parse_tables(docs, "history", ["TRADEDATE", "CLOSE"], keep=["secid"]).groupBy("secid").agg(F.count("tradedate").alias("n"), F.sum("close").alias("total")).collect()
    assert sorted((r.secid, r.n, r.total) for r in rows) == [(s, 3000, sum(100 + i / 8 for i in range(3000))) for s in ("B1", "B2")]
    assert time.perf_counter() - start < 60
