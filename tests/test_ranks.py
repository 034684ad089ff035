"""Ranks of large groups against windows over whole groups."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tickloom.functions.core import pct_rank_avg
from tickloom.functions.ranks import large_pct_ranks, large_top


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(5)
    data = [(r.choice(["a", "b"]), f"t{i:05d}", r.choice([None, float(r.randrange(5)), r.gauss(0, 1), r.gauss(0, 1e6)])) for i in range(3000)]
    data += [("ties", f"u{i:03d}", 1.0) for i in range(100)] + [("one", "v", 3.0), ("null", "w", None)]
    return spark.createDataFrame(data, "month string, ticker string, x double").repartition(4).cache()


@pytest.mark.parametrize("bins", [2, 64])
def test_pct_ranks(rows, bins):
    got = {r.ticker: r.p for r in large_pct_ranks(rows, "x", ["month"], "p", bins).collect()}
    want = {r.ticker: r.p for r in rows.withColumn("p", pct_rank_avg(F.col("x"), "month")).collect()}
    assert set(got) == set(want) and all(got[k] == (pytest.approx(p) if p is not None else None) for k, p in want.items())


@pytest.mark.parametrize("how", [{"n": 7}, {"n": 5000}, {"share": 0.2}, {"share": 0.0}])
def test_top(rows, how):
    got = {(r.month, r.ticker) for r in large_top(rows, "x", ["month"], **how).collect()}
    have = rows.where("x is not null")
    place = F.row_number().over(W.partitionBy("month").orderBy(F.desc("x"), "ticker"))
    k = F.lit(how["n"]) if "n" in how else F.greatest(F.lit(1), F.floor(F.count("*").over(W.partitionBy("month")) * how["share"]))
    assert got == {(r.month, r.ticker) for r in have.withColumn("p", place).withColumn("k", k).where("p <= k").collect()}
    assert large_top(rows, "x", ["month"], **how).count() == len(got)


def test_edges_that_differ_from_run_to_run(rows, spark, monkeypatch):
    """Approximate quantiles depend on the order in which executors answer: here they are other ones at each evaluation."""

    def quantiles(value, places, _accuracy):
        def draw(x: pd.Series) -> list[float]:
            return np.sort(np.random.default_rng().choice(x, len(places))).tolist()

        return F.pandas_udf(draw, "array<double>", F.PandasUDFType.GROUPED_AGG)(value)

    monkeypatch.setattr(F, "percentile_approx", quantiles)
    want = {r.ticker: r.p for r in rows.withColumn("p", pct_rank_avg(F.col("x"), "month")).collect()}
    got = {r.ticker: r.p for r in large_pct_ranks(rows, "x", ["month"], "p", 8).collect()}
    assert set(got) == set(want) and all(got[k] == (pytest.approx(p) if p is not None else None) for k, p in want.items())
    place = F.row_number().over(W.partitionBy("month").orderBy(F.desc("x"), "ticker"))
    k = F.greatest(F.lit(1), F.floor(F.count("*").over(W.partitionBy("month")) * 0.2))
    best = {(r.month, r.ticker) for r in rows.where("x is not null").withColumn("p", place).withColumn("k", k).where("p <= k").collect()}
    top = [(r.month, r.ticker) for r in large_top(rows, "x", ["month"], share=0.2, bins=8).collect()]
    assert set(top) == best and len(top) == len(best)
