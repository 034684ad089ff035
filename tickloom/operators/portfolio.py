"""Complete-case panels, correlation and covariance, shrinkage, frontier scans."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.core import ratio
from ..schemas import DAYS
from ..scratch import durable
from .performance import with_returns

#: Tickers of a block and days of a chunk: matrices of at most about a megabyte.
BLOCK, CHUNK = 256, 512


def complete_case(bars: DataFrame, tickers: DataFrame | None = None, price: str = "close") -> DataFrame:
    """``ticker, date, px`` on the dates on which every ticker of the universe has a price."""
    rows = bars.where(F.col(price).isNotNull()).select("ticker", "date", F.col(price).alias("px"))
    rows = rows.join(tickers.select("ticker"), "ticker", "left_semi") if tickers is not None else rows
    size = F.broadcast(rows.agg(F.count_distinct("ticker").alias("_size")))  # one row
    full = rows.groupBy("date").agg(F.count_distinct("ticker").alias("_n")).join(size, F.col("_n") == F.col("_size")).select("date")
    return rows.join(full, "date", "left_semi")


def panel_returns(complete: DataFrame) -> DataFrame:
    return with_returns(complete, "px").where("ret is not null").select("ticker", "date", "ret")


def pair_sums(returns: DataFrame, block: int = BLOCK, days: int = CHUNK) -> DataFrame:
    """``a, b, n, sx, sy, sxx, syy, sxy, sq`` for each pair of tickers (a <= b) with dates in common: sums over these of the returns, of their
    products, and of the products' squares. A ticker has one return a date; returns are centred by ticker, so that sums of squares don't cancel.

    Tickers are dealt to blocks and dates to chunks; two blocks meet in each chunk as two matrices, whose products are the sums. No pair of
    returns becomes a row: a ticker's returns are sent once to each block.
    """
    own = durable(returns.where("ret is not null").select("ticker", "date", (F.col("ret") - F.avg("ret").over(W.partitionBy("ticker"))).alias("ret")), "centred-returns")
    blocks = max(-(-own.select("ticker").distinct().count() // block), 1)
    day = F.datediff("date", F.lit("1970-01-01").cast("date"))
    cells = own.select("ticker", "ret", F.pmod(F.xxhash64("ticker"), F.lit(blocks)).alias("block"), F.floor(day / days).alias("chunk"), F.pmod(day, F.lit(days)).alias("day"))
    side = lambda x: cells.groupBy("chunk", F.col("block").alias(f"block_{x}")).agg(*[F.collect_list(c).alias(f"{c}_{x}") for c in ("ticker", "day", "ret")])
    met = side("a").join(side("b"), "chunk").where("block_a <= block_b")

    def matrix(tickers: np.ndarray, day: np.ndarray, ret: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        names, row = np.unique(np.asarray(tickers, object).astype(str), return_inverse=True)
        x, known = np.zeros((len(names), days)), np.zeros((len(names), days))
        x[row, day], known[row, day] = ret, 1.0
        return names, x, known

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                a, x, mx = matrix(r.ticker_a, r.day_a, r.ret_a)
                b, y, my = matrix(r.ticker_b, r.day_b, r.ret_b)
                sums = {"n": mx @ my.T, "sx": x @ my.T, "sy": mx @ y.T, "sxx": (x * x) @ my.T, "syy": mx @ (y * y).T, "sxy": x @ y.T, "sq": (x * x) @ (y * y).T}
                i, j = np.nonzero((sums["n"] > 0) & ((a[:, None] <= b[None, :]) | (r.block_a < r.block_b)))
                out = pd.DataFrame({"a": a[i], "b": b[j], **{k: v[i, j] for k, v in sums.items()}})
                turned = out["a"] > out["b"]
                for one, two in (("a", "b"), ("sx", "sy"), ("sxx", "syy")):
                    out.loc[turned, [one, two]] = out.loc[turned, [two, one]].to_numpy()
                yield out.astype({"n": "int64"})

    names = ("sx", "sy", "sxx", "syy", "sxy", "sq")
    sums = met.mapInPandas(run, "a string, b string, n long, " + ", ".join(f"{c} double" for c in names))
    return sums.groupBy("a", "b").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in names])


def _moment(x: str, y: str) -> Column:
    """The sum of products of deviations from the means over the dates in common."""
    return F.col(f"s{min(x, y)}{max(x, y)}") - F.col(f"s{x}") * F.col(f"s{y}") / F.col("n")


def correlations(returns: DataFrame) -> DataFrame:
    corr = ratio(_moment("x", "y"), F.nullif(F.sqrt(_moment("x", "x") * _moment("y", "y")), F.lit(0.0)))
    return pair_sums(returns).select("a", "b", corr.alias("corr"), "n")


def expected_returns(returns: DataFrame, days: int = DAYS) -> DataFrame:
    """``ticker, mu``: the compounded mean return of a year."""
    return returns.groupBy("ticker").agg((F.pow(F.product(1 + F.col("ret")), days / F.count("*")) - 1).alias("mu"))


def covariances(returns: DataFrame, days: int = DAYS) -> DataFrame:
    """``a, b, cov``: sample covariances of a year, a <= b."""
    return pair_sums(returns).select("a", "b", (ratio(_moment("x", "y"), F.nullif(F.col("n") - 1, F.lit(0)).cast("double")) * days).alias("cov"))


def ledoit_wolf(returns: DataFrame, days: int = DAYS) -> DataFrame:
    """``a, b, cov, shrinkage``: covariances shrunk to a multiple of the identity by the published Ledoit-Wolf intensity.

    Needs a complete panel, whose centred returns sum to 0. All sums are over pairs: S from second moments, the error of S from fourth.
    """
    n = F.col("n")
    per = durable(pair_sums(returns).select("a", "b", (F.col("sxy") / n).alias("s"), (F.col("sq") / n).alias("q"), "n"), "pair-moments")
    both = F.when(F.col("a") == F.col("b"), 1.0).otherwise(2.0)  # each pair stands for both orders
    diagonal = F.when(F.col("a") == F.col("b"), F.col("s"))
    sums = per.agg(F.count(diagonal).alias("p"), F.sum(diagonal).alias("trace"), F.sum(both * F.col("s") * F.col("s")).alias("ss"), F.sum(both * (F.col("q") - F.col("s") * F.col("s"))).alias("err"), F.max("n").alias("_n"))
    mu = F.col("trace") / F.col("p")
    d2 = F.col("ss") - F.col("p") * mu * mu
    b2 = F.least(F.col("err") / F.col("_n"), d2)
    sums = sums.select(mu.alias("mu"), F.coalesce(ratio(b2, F.nullif(d2, F.lit(0.0))), F.lit(0.0)).alias("shrinkage"))
    shrunk = (1 - F.col("shrinkage")) * F.col("s") + F.when(F.col("a") == F.col("b"), F.col("shrinkage") * F.col("mu")).otherwise(0.0)
    return per.join(F.broadcast(sums)).select("a", "b", (shrunk * days).alias("cov"), "shrinkage")


def candidate_portfolios(tickers: DataFrame, n: int = 2_000, cap: float = 0.3, seed: int = 11) -> DataFrame:
    """``portfolio, ticker, w``: long-only weights from hashed exponentials, capped by handing the excess on once, summing to 1."""
    ids = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    u = (F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("portfolio").cast("string"), "ticker")), 1, 8), 16, 10).cast("double") + 0.5) / 2.0**32
    raw = tickers.select("ticker").distinct().select("ticker", ids.alias("portfolio")).withColumn("e", F.pow(-F.ln(u), 2))
    part = W.partitionBy("portfolio")
    w = raw.withColumn("w", F.col("e") / F.sum("e").over(part))
    over = F.sum(F.greatest(F.col("w") - cap, F.lit(0.0))).over(part)
    room = F.greatest(cap - F.col("w"), F.lit(0.0))
    capped = F.least(F.col("w"), F.lit(cap)) + F.coalesce(over * ratio(room, F.nullif(F.sum(room).over(part), F.lit(0.0))), F.lit(0.0))
    return w.select("portfolio", "ticker", capped.alias("w"))


def variances(portfolios: DataFrame, cov: DataFrame, block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """``portfolio, var`` from weights (portfolio, ticker, w) and covariances (a <= b); pairs without a covariance count as 0.

    Tickers are dealt to blocks and portfolios to chunks: a block of covariances meets a chunk's weights on either side as matrices, so no pair
    of holdings becomes a row, and a weight is sent once to each block.
    """
    own = durable(portfolios.select("portfolio", "ticker", F.col("w").cast("double").alias("w")), "weights")
    sizes = own.agg(F.count_distinct("ticker").alias("tickers"), F.count_distinct("portfolio").alias("portfolios")).first()
    deal = lambda c, n, most: F.pmod(F.xxhash64(c), F.lit(max(-(-n // most), 1)))
    at = lambda c: deal(c, sizes.tickers, block)
    cells = own.withColumn("block", at("ticker")).withColumn("chunk", deal("portfolio", sizes.portfolios, chunk))
    side = lambda x: cells.groupBy("chunk", F.col("block").alias(f"block_{x}")).agg(*[F.collect_list(c).alias(f"{c}_{x}") for c in ("portfolio", "ticker", "w")])
    pairs = cov.where("cov is not null").groupBy(at("a").alias("block_a"), at("b").alias("block_b")).agg(*[F.collect_list(c).alias(c) for c in ("a", "b", "cov")])
    met = pairs.join(side("a"), "block_a").join(side("b"), ["chunk", "block_b"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                names = pd.Index(np.intersect1d(r.portfolio_a, r.portfolio_b))
                a, b = pd.Index(r.a).unique(), pd.Index(r.b).unique()
                c, known = np.zeros((len(a), len(b))), np.zeros((len(a), len(b)))
                i, j = a.get_indexer(r.a), b.get_indexer(r.b)
                c[i, j], known[i, j] = np.where(np.asarray(r.a) == np.asarray(r.b), 1.0, 2.0) * r.cov, 1.0

                def matrix(portfolio: np.ndarray, ticker: np.ndarray, w: np.ndarray, columns: pd.Index) -> tuple[np.ndarray, np.ndarray]:
                    row, col = names.get_indexer(portfolio), columns.get_indexer(ticker)  # noqa: B023
                    held = (row >= 0) & (col >= 0)
                    x, there = np.zeros((len(names), len(columns))), np.zeros((len(names), len(columns)))  # noqa: B023
                    x[row[held], col[held]], there[row[held], col[held]] = np.asarray(w)[held], 1.0
                    return x, there

                x, has_x = matrix(r.portfolio_a, r.ticker_a, r.w_a, a)
                y, has_y = matrix(r.portfolio_b, r.ticker_b, r.w_b, b)
                met = ((has_x @ known) * has_y).sum(axis=1) > 0
                yield pd.DataFrame({"portfolio": names[met], "var": ((x @ c) * y).sum(axis=1)[met]})

    kind = own.schema["portfolio"].dataType.simpleString()
    return met.mapInPandas(run, f"portfolio {kind}, var double").groupBy("portfolio").agg(F.sum("var").alias("var"))


def evaluate(portfolios: DataFrame, mu: DataFrame, cov: DataFrame, rf: float = 0.0) -> DataFrame:
    """``portfolio, ret, vol, sharpe``: sums over holdings and over pairs of holdings."""
    ret = portfolios.join(mu, "ticker").groupBy("portfolio").agg(F.sum(F.col("w") * F.col("mu")).alias("ret"))
    vol = F.sqrt(F.greatest("var", F.lit(0.0)))
    return ret.join(variances(portfolios, cov), "portfolio").select("portfolio", "ret", vol.alias("vol"), ratio(F.col("ret") - rf, F.nullif(vol, F.lit(0.0))).alias("sharpe"))


def _mix(corners: pd.DataFrame) -> pd.DataFrame:
    """Shares of one portfolio's corners that minimise variance / 2 - gain: weight goes from the corner of the steepest slope to that of the least."""
    k = int(corners["corner"].max()) + 1
    c, gain = np.zeros((k, k)), np.zeros(k)
    c[corners["corner"], corners["other"]] = corners["c"]
    gain[corners["corner"]] = corners["gain"]
    c = (c + c.T) / 2
    share = np.full(k, 1.0 / k)
    for _ in range(1_000 * k):
        slope = c @ share - gain
        low, high = int(slope.argmin()), int(np.where(share > 0, slope, -np.inf).argmax())
        if slope[high] - slope[low] <= 1e-10 * max(float(np.abs(c).max()), 1e-300):
            break
        bend = c[low, low] + c[high, high] - 2 * c[low, high]
        step = min(share[high], (slope[high] - slope[low]) / bend) if bend > 0 else share[high]
        share[low] += step
        share[high] = max(share[high] - step, 0.0)
    var = float(share @ c @ share)
    return pd.DataFrame({"portfolio": corners["portfolio"].iloc[0], "corner": np.arange(k), "share": share, "var": var, "slope": var - float(share @ gain)})


def efficient_portfolios(mu: DataFrame, cov: DataFrame, tolerances: tuple[float, ...] = (0.0,), cap: float = 0.3, rounds: int = 40, gap: float = 0.01) -> DataFrame:
    """``portfolio, ticker, w``: for the i-th of ``tolerances`` t, the long-only weights of at most ``cap`` that minimise variance / 2 - t * return.

    Frank-Wolfe steps, fully corrected: a portfolio's new corner holds at their caps the tickers along which the objective falls fastest; the
    covariances are joined with the few holdings of new corners only, and all corners so far are mixed by their own small matrix. It ends
    when no portfolio can gain more than ``gap`` of its variance, which for t = 0 bounds the error of its volatility by that share, or
    after ``rounds``. With fewer tickers than 1 / cap, all are held alike.
    """
    tickers = mu.select("ticker").distinct().count()
    if not tickers:
        return mu.select(F.lit(0).alias("portfolio"), "ticker", F.lit(0.0).alias("w"))
    cap = max(cap, 1.0 / tickers)
    holdings = int(np.ceil(1 / cap - 1e-9))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("portfolio"), F.lit(float(t)).alias("t")) for i, t in enumerate(tolerances)]))
    base = durable(mu.select("ticker", (F.coalesce("mu", F.lit(0.0))).alias("mu"), wanted.alias("p")).select("p.portfolio", "ticker", (F.col("p.t") * F.col("mu")).alias("gain")), "gains")
    known = cov.where("cov is not null")
    full = durable(known.select(F.col("a").alias("ticker"), F.col("b").alias("held"), "cov").unionByName(known.where("a <> b").select(F.col("b").alias("ticker"), F.col("a").alias("held"), "cov")), "covariances")

    def corner(slopes: DataFrame, at: int) -> DataFrame:
        place = F.row_number().over(W.partitionBy("portfolio").orderBy("slope", "ticker"))
        v = F.least(F.lit(cap), F.greatest(1 - (F.col("place") - 1) * cap, F.lit(0.0)))
        return durable(slopes.withColumn("place", place).where(F.col("place") <= holdings).select("portfolio", F.lit(at).alias("corner"), "ticker", v.alias("v"), "slope"), "corner")

    new = corner(base.join(full.where("ticker = held").select("ticker", "cov"), "ticker").select("portfolio", "ticker", (F.col("cov") - F.col("gain")).alias("slope")), 0)
    held = pulled = None
    for at in range(rounds):
        # a row for each holding of each portfolio's new corner: bounded by the parameters
        few = F.broadcast(new.select("portfolio", "corner", F.col("ticker").alias("held"), "v"))
        pull = durable(full.join(few, "held").groupBy("portfolio", "corner", "ticker").agg(F.sum(F.col("cov") * F.col("v")).alias("pull")), "pull")
        own = new.select("portfolio", "corner", "ticker", "v")
        held, pulled = (own, pull) if held is None else (held.unionByName(own), pulled.unionByName(pull))
        gains = held.join(base, ["portfolio", "ticker"]).groupBy("portfolio", "corner").agg(F.sum(F.col("v") * F.col("gain")).alias("gain"))
        cells = held.join(pulled.withColumnRenamed("corner", "other"), ["portfolio", "ticker"]).groupBy("portfolio", "corner", "other").agg(F.sum(F.col("v") * F.col("pull")).alias("c"))
        shares = durable(cells.join(gains, ["portfolio", "corner"]).groupBy("portfolio").applyInPandas(_mix, "portfolio int, corner int, share double, var double, slope double"), "shares")
        slopes = pulled.join(shares.select("portfolio", "corner", "share"), ["portfolio", "corner"]).select("portfolio", "ticker", (F.col("share") * F.col("pull")).alias("slope"))
        slopes = slopes.unionByName(base.select("portfolio", "ticker", (-F.col("gain")).alias("slope"))).groupBy("portfolio", "ticker").agg(F.sum("slope").alias("slope"))
        new = corner(slopes, at + 1)
        ahead = new.groupBy("portfolio").agg(F.sum(F.col("v") * F.col("slope")).alias("least"))
        if shares.select("portfolio", "var", "slope").distinct().join(ahead, "portfolio").where(F.col("slope") - F.col("least") > gap * F.col("var")).isEmpty():
            break
    return held.join(shares, ["portfolio", "corner"]).groupBy("portfolio", "ticker").agg(F.sum(F.col("v") * F.col("share")).alias("w")).where("w > 0")


def frontier_scan(evaluated: DataFrame, buckets: int = 20) -> DataFrame:
    """The best Sharpe, the least volatility, and the least volatile portfolio of each return bucket: an approximation of the frontier by scan."""
    lim = F.broadcast(evaluated.agg(F.min("ret").alias("lo"), F.max("ret").alias("hi")))  # one row
    bucket = F.least(F.floor((F.col("ret") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * buckets), F.lit(buckets - 1)).cast("int")
    own = F.struct("portfolio", "ret", "vol", "sharpe")
    edge = evaluated.join(lim).groupBy(bucket.alias("bucket")).agg(F.min_by(own, F.struct("vol", "portfolio")).alias("p")).select(F.concat(F.lit("bucket-"), "bucket").alias("kind"), "p.*")
    best = evaluated.agg(F.max_by(own, F.struct("sharpe", "portfolio")).alias("p")).select(F.lit("max-sharpe").alias("kind"), "p.*")
    low = evaluated.agg(F.min_by(own, F.struct("vol", "portfolio")).alias("p")).select(F.lit("min-vol").alias("kind"), "p.*")
    return edge.unionByName(best).unionByName(low)
