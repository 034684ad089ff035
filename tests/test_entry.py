"""Every registered query with SQL gives what DuckDB gives, on the smallest tables."""

import datetime as dt
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tickloom.plans import queries as market

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(rows):
    return sorted(repr(tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v.date() if isinstance(v, dt.datetime) else v) for v in r)) for r in rows)


MARKET = [n for n in entry.oracle_sql() if not n.startswith(("op", "pipeline"))]


@pytest.mark.parametrize("name", MARKET)
def test_against_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    order = ", ".join(f'"{c}"' for c in cols)
    assert plain(map(tuple, df.select(cols).collect())) == plain(rel.project(order).fetchall())


def test_no_brand_order_or_forecast_is_left_out(spark):
    """k57 takes every ticker with a full history, k66 all 15 orders, k68 the last fifth of the returns."""
    sf, q = "/root/testdata/sf0.1", entry.queries()  # smaller tables have no date with all brands
    full = {r.ticker for r in q["b8_complete_history"](spark, sf).collect()}
    assert len(full) > 3 and {r.a for r in q["k57_ledoit_wolf"](spark, sf).collect()} == full
    orders = [(r.ticker, r.p, r.q) for r in q["k66_arma_orders"](spark, SF).collect()]
    assert orders and max(p for _, p, _ in orders) == max(q for _, _, q in orders) == 3
    n = {r.ticker: r.n for r in market._lret(spark, SF).groupBy("ticker").agg(F.count("*").alias("n")).collect()}
    errors = {r.ticker: r.n for r in q["k68_forecast_errors"](spark, SF).collect()}
    assert errors and all(abs(errors[t] - 0.2 * n[t]) <= 2 for t in errors)


def test_flagship_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_works_without_the_training_data_part():
    assert os.path.isdir(os.path.join(os.path.dirname(entry.__file__), "tickloom"))
    assert "k9_period_performance" in entry.queries()
