"""Bond yield and duration as column expressions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import YEAR_DAYS

#: Yields searched, as fractions. Newton's steps: on the logarithm of the value, which is convex in ln(1 + y / freq) and nearly a line.
LOW, HIGH, STEPS = -0.5, 5.0, 8


def annuity(u: Column, n: Column) -> Column:
    """Value of ``n`` payments of 1 at a rate of exp(u) - 1 a period."""
    r = F.expm1(u)
    return F.when(F.abs(u) < 1e-12, n.cast("double")).otherwise(-F.expm1(-n * u) / r)


def present_value(u: Column, face: Column, coupon: Column, n: Column) -> Column:
    """Value of ``n`` coupons and the face where a period's rate is exp(u) - 1; the annuity in closed form."""
    return coupon * annuity(u, n) + face * F.exp(-n * u)


def weighted_time(u: Column, face: Column, coupon: Column, n: Column) -> Column:
    """The sum of payments' values times their periods; near a rate of 0, where the closed form cancels, by its limit."""
    r, disc = F.expm1(u), F.exp(-n * u)
    coupons = F.when(F.abs(u) < 1e-6, n * (n + 1) / 2.0).otherwise(((1 + r) * annuity(u, n) - n * disc) / r)
    return coupon * coupons + face * n * disc


def _newton(u: Column, price: Column, face: Column, coupon: Column, n: Column, freq: int) -> Column:
    value = present_value(u, face, coupon, n)
    step = F.try_divide(F.ln(value / price) * value, weighted_time(u, face, coupon, n))
    return F.least(F.greatest(u + step, F.lit(math.log(1 + LOW / freq))), F.lit(math.log(1 + HIGH / freq)))


def _solved(u: Column, price: Column, face: Column, coupon: Column, n: Column, freq: int) -> Column:
    low, high = (present_value(F.lit(math.log(1 + x / freq)), face, coupon, n) for x in (LOW, HIGH))
    inner = F.expm1(u) * freq * 100
    return F.when(price.isNull() | n.isNull(), F.lit(None).cast("double")).when(n <= 0, 0.0).when(price >= low, LOW * 100).when(price <= high, HIGH * 100).otherwise(inner)


def ytm(price: Column, face: Column, coupon_rate: Column, years: Column, freq: int = 2) -> Column:
    """Yield to maturity in percent between -50 and 500, where it is clamped; no periods left: 0; null price: null."""
    n, coupon = F.floor(years * freq), face * coupon_rate / 100 / freq
    found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), F.lit(0.0), lambda u, _: F.coalesce(_newton(u, price, face, coupon, n, freq), F.lit(0.0)))
    return _solved(found, price, face, coupon, n, freq)


def with_yield(df: DataFrame, price: str, face: str, coupon_rate: str, years: str, freq: int = 2) -> DataFrame:
    """Adds ``ytm`` as the function does, Newton's steps on batches of rows: unrolled into columns they make a method of more bytes than
    the virtual machine compiles."""
    least, most = math.log(1 + LOW / freq), math.log(1 + HIGH / freq)

    def solve(price: pd.Series, face: pd.Series, coupon: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(newton(*(x.to_numpy("float64") for x in (price, face, coupon, n)), least, most))

    cols = df.columns
    p, f, n, c = F.col(price), F.col(face), F.col("_n"), F.col("_c")
    df = df.withColumns({"_n": F.floor(F.col(years) * freq), "_c": f * F.col(coupon_rate) / 100 / freq})
    df = df.withColumn("_u", F.pandas_udf(solve, "double")(p, f, c, n.cast("double")))
    return df.select(*cols, _solved(F.col("_u"), p, f, c, n, freq).alias("ytm"))


def newton(price: np.ndarray, face: np.ndarray, coupon: np.ndarray, n: np.ndarray, least: float, most: float) -> np.ndarray:
    """The logarithm of 1 + a period's rate at which payments are worth ``price``, by the steps of ``_newton``; missing numbers are NaN."""
    u = np.zeros(len(price))
    with np.errstate(all="ignore"):
        for _ in range(STEPS):
            r, disc = np.expm1(u), np.exp(-n * u)
            paid = np.where(np.abs(u) < 1e-12, n, -np.expm1(-n * u) / r)
            value = coupon * paid + face * disc
            coupons = np.where(np.abs(u) < 1e-6, n * (n + 1) / 2, ((1 + r) * paid - n * disc) / r)
            weighted = coupon * coupons + face * n * disc
            u = np.minimum(np.fmax(u + np.log(value / price) * value / weighted, least), most)
    return u


def modified_duration(face: Column, coupon_rate: Column, years: Column, ytm_pct: Column, freq: int = 2) -> Column:
    """Macaulay duration over (1 + y / freq), in years; no periods left: 0."""
    n = F.floor(years * freq)
    u = F.log1p(ytm_pct / 100 / freq)
    coupon = face * coupon_rate / 100 / freq
    mean = F.try_divide(weighted_time(u, face, coupon, n), present_value(u, face, coupon, n))
    return F.when(ytm_pct.isNull() | years.isNull(), F.lit(None).cast("double")).when(n <= 0, 0.0).otherwise(mean / freq / F.exp(u))


def bond_metrics(prices: DataFrame, params: DataFrame, price: str = "close", freq: int = 2) -> DataFrame:
    """Adds ``years_to_maturity, ytm, duration``. Prices are percent of face; defaults: face 1000, coupon 0; no maturity: nulls."""
    own = params.select("secid", F.coalesce("facevalue", F.lit(1000.0)).alias("_face"), F.coalesce("couponpercent", F.lit(0.0)).alias("_coupon"), F.col("matdate").alias("_mat"))
    out = prices.join(own, "secid", "left").withColumn("years_to_maturity", F.datediff("_mat", "tradedate") / YEAR_DAYS)
    out = out.withColumns({"_face": F.coalesce("_face", F.lit(1000.0)), "_coupon": F.coalesce("_coupon", F.lit(0.0))}).withColumn("_price", F.col(price) / 100 * F.col("_face"))
    out = with_yield(out, "_price", "_face", "_coupon", "years_to_maturity", freq)
    duration = modified_duration(F.col("_face"), F.col("_coupon"), F.col("years_to_maturity"), F.col("ytm"), freq)
    return out.withColumn("duration", duration).drop("_face", "_coupon", "_mat", "_price")
