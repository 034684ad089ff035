"""Monthly momentum strategies on long tables.

Tables are keyed by ``ticker, month`` (a month's last day) with ``ord``, the month's number; months without any data are not counted.
All configurations of a grid run in one plan: rows carry ``config``, and every window is partitioned by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ..functions.core import dense_grid, drawdown, growth, pct_rank_avg, ratio, rolling
from ..functions.series import ewma
from ..schemas import DAYS, MONTHS
from ..scratch import durable
from .performance import by_date, dense_closes, with_returns


def by_month() -> WindowSpec:
    return W.partitionBy("ticker").orderBy("ord")


def monthly_panel(bars: DataFrame, price: str = "close", total: str | None = None) -> DataFrame:
    """``ticker, month, ord, px, turnover, ret, vol, div`` on the grid of all tickers and months.

    px: the month's last positive price; turnover: its sum, null without bars; ret: against the month before, gaps not filled; vol:
    63-day (at least 21) volatility at the last day of the calendar in the month; div: total less price return over 12 months.
    """
    month = F.last_day("date").alias("month")
    rows = bars.where(F.col(price) > 0)
    tot = F.max_by(total, "date").alias("tr") if total else F.lit(None).cast("double").alias("tr")
    per = rows.groupBy("ticker", month).agg(F.max_by(price, "date").alias("px"), tot)
    turn = bars.groupBy("ticker", month).agg(F.sum("value_rub").alias("turnover"))
    daily = with_returns(dense_closes(rows, price)).withColumn("v", rolling(F.stddev_samp, "ret", 63, by_date(), 21) * DAYS**0.5)
    vol = daily.groupBy("ticker", month).agg(F.max_by("v", F.when(F.col("v").isNotNull(), F.col("date"))).alias("vol"))
    panel = dense_grid(per, time="month").join(turn, ["ticker", "month"], "left").join(vol, ["ticker", "month"], "left")
    change = lambda c, k: ratio(F.col(c), F.lag(c, k).over(by_month()))
    return panel.select("ticker", "month", "ord", "px", "turnover", (change("px", 1) - 1).alias("ret"), "vol", (change("tr", 12) - change("px", 12)).alias("div"))


def panel_status(panel: DataFrame) -> DataFrame:
    """Tickers, months, first and last month, whether the last is partial is left to the caller's dates; returns of -100% or less; one row."""
    return panel.agg(F.count_distinct("ticker").alias("tickers"), F.count_distinct("month").alias("months"), F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.count_if(F.col("ret") <= -1).alias("wiped_out"))


def benchmark_monthly(index_bars: DataFrame) -> DataFrame:
    """``month, bench``: monthly returns of an index; and its trend at the month's end: fast above slow mean, price above its 200-day mean."""
    month = F.last_day("date").alias("month")
    daily = ewma(index_bars.select("ticker", "date", "close"), "close", (16, 64)).withColumn("ma", rolling(F.avg, "close", 200, by_date(), 100))
    per = daily.groupBy(month).agg(F.max_by("close", "date").alias("px"), F.max_by("ewma_16", "date").alias("fast"), F.max_by("ewma_64", "date").alias("slow"), F.max_by("ma", "date").alias("ma"))
    return per.select("month", (ratio(F.col("px"), F.lag("px").over(W.orderBy("month"))) - 1).alias("bench"), (F.col("fast") > F.col("slow")).cast("double").alias("ewmac"), F.when(F.col("ma").isNotNull(), (F.col("px") > F.col("ma")).cast("double")).alias("above_ma"))


def momentum_signal(panel: DataFrame, lookback: int, skip: int) -> DataFrame:
    """Adds ``mom``: the price ``skip`` months ago over that ``lookback`` months before, less 1."""
    return panel.withColumn("mom", ratio(F.lag("px", skip).over(by_month()), F.lag("px", lookback + skip).over(by_month())) - 1)


def composite_signal(panel: DataFrame, w_mom: float = 1.0, w_lowvol: float = 0.5, w_div: float = 0.5) -> DataFrame:
    """Adds ``score``: the weighted mean of the month's percentile ranks of momentum, low volatility and dividends. A missing factor leaves
    the weights; without momentum there is no score."""
    ranks = [(pct_rank_avg(F.col("mom"), "month"), w_mom), (pct_rank_avg(-F.col("vol"), "month"), w_lowvol), (pct_rank_avg(F.col("div"), "month"), w_div)]
    for i, (rank, _) in enumerate(ranks):
        panel = panel.withColumn(f"_r{i}", rank)
    top = sum((F.coalesce(F.col(f"_r{i}") * w, F.lit(0.0)) for i, (_, w) in enumerate(ranks)), F.lit(0.0))
    under = sum((F.when(F.col(f"_r{i}").isNotNull(), w).otherwise(0.0) for i, (_, w) in enumerate(ranks)), F.lit(0.0))
    return panel.withColumn("score", F.when(F.col("mom").isNotNull(), ratio(top, F.nullif(under, F.lit(0.0))))).drop("_r0", "_r1", "_r2")


def rebalance_weights(signal: DataFrame, by: Sequence[str] = ("month",), value: str = "mom", q: Column | float = 0.2, long_short: Column | bool = False, top_n: int | None = None, weighting: str = "equal", vol: str = "vol") -> DataFrame:
    """``by, ticker, weight`` of each month's portfolio.

    The universe is the ``top_n`` names by turnover, if the month has any turnover; the long leg is the best max(1, floor(n * q)) names,
    the short leg the worst, which overwrites the long one where they meet. ``inverse_vol`` weighs by 1 / volatility within a leg: names
    without one get 0, a leg without any is equal. Ties go by ticker.
    """
    q, both = (x if isinstance(x, Column) else F.lit(x) for x in (q, long_short))
    part = W.partitionBy(*by)
    rows = signal
    if top_n:
        place = F.row_number().over(part.orderBy(F.col("turnover").desc_nulls_last(), "ticker"))
        rows = rows.withColumn("_any", F.count("turnover").over(part)).withColumn("_p", place).where((F.col("_any") == 0) | ((F.col("_p") <= top_n) & F.col("turnover").isNotNull()))
    rows = rows.where(F.col(value).isNotNull()).withColumn("_n", F.count("*").over(part)).withColumn("_k", F.greatest(F.lit(1), F.floor(F.col("_n") * q)))
    rows = rows.withColumn("_long", F.row_number().over(part.orderBy(F.desc(value), "ticker")) <= F.col("_k")).withColumn("_short", both & (F.row_number().over(part.orderBy(F.asc(value), "ticker")) <= F.col("_k")))
    legs = []
    for leg, sign in (("_long", 1.0), ("_short", -1.0)):
        if weighting == "inverse_vol":
            inverse = F.when(F.col(leg) & (F.col(vol) > 0), 1 / F.col(vol))
            total = F.sum(inverse).over(part)
            w = F.when(total > 0, F.coalesce(inverse, F.lit(0.0)) / total).otherwise(1.0 / F.col("_k"))
        else:
            w = 1.0 / F.col("_k")
        legs.append(F.when(F.col(leg), sign * w))
    return rows.select(*by, "ticker", *([c for c in ("ord",) if c in signal.columns and c not in by]), F.coalesce(legs[1], legs[0]).alias("weight")).where("weight is not null")


def apply_holding(weights: DataFrame, hold: Column | int, months: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The mean of the last ``hold`` months' weights, missing ones 0: each weight is spread over the months that hold it.

    ``weights`` has ord; ``months`` is ``month, ord``.
    """
    h = hold if isinstance(hold, Column) else F.lit(hold)
    spread = weights.select(*by, "ticker", F.explode(F.sequence(F.col("ord"), F.col("ord") + h - 1)).alias("ord"), (F.col("weight") / h).alias("w"))
    return spread.groupBy(*by, "ticker", "ord").agg(F.sum("w").alias("weight")).join(F.broadcast(months), "ord")  # a row a month


def trend_gate(weights: DataFrame, trend: DataFrame, signal: str = "ewmac") -> DataFrame:
    """Weights times the month's trend signal; a missing one means in the market."""
    return weights.join(F.broadcast(trend.select("month", F.col(signal).alias("_gate"))), "month", "left").withColumn("weight", F.col("weight") * F.coalesce("_gate", F.lit(1.0))).drop("_gate")


def backtest_monthly(returns: DataFrame, weights: DataFrame, months: DataFrame, tc_bps: float = 0.0, missing: str = "exit", by: Sequence[str] = ()) -> DataFrame:
    """``by, month, ord, ret_gross, turnover, tc, ret_net`` for each month.

    A month earns its returns on the weights of the month before. A missing return, or one of -100% or less, on an open position counts
    as 0 (``exit``) or -1 (``penalize``). Turnover is half the sum of weight changes, the first month from nothing.
    """
    bad = 0.0 if missing == "exit" else -1.0
    w = weights.where("weight <> 0").select(*by, "ticker", "ord", "weight")
    held = w.withColumn("ord", F.col("ord") + 1).join(returns.select("ticker", "ord", "ret"), ["ticker", "ord"], "left")
    gross = held.groupBy(*by, "ord").agg(F.sum(F.col("weight") * F.when(F.col("ret").isNull() | (F.col("ret") <= -1), bad).otherwise(F.col("ret"))).alias("ret_gross"))
    # a change is this month's weight less the one before: each weight counts for both months
    moves = w.unionByName(w.withColumn("ord", F.col("ord") + 1).withColumn("weight", -F.col("weight"))).groupBy(*by, "ticker", "ord").agg(F.sum("weight").alias("d"))
    turn = moves.groupBy(*by, "ord").agg((F.sum(F.abs("d")) / 2).alias("turnover"))
    grid = months.select("month", "ord")
    if by:
        grid = weights.select(*by).distinct().join(F.broadcast(grid))
    out = grid.join(gross, [*by, "ord"], "left").join(turn, [*by, "ord"], "left")
    gross_, turn_ = F.coalesce("ret_gross", F.lit(0.0)), F.coalesce("turnover", F.lit(0.0))
    tc = turn_ * tc_bps / 1e4
    return out.select(*by, "month", "ord", gross_.alias("ret_gross"), turn_.alias("turnover"), tc.alias("tc"), (gross_ - tc).alias("ret_net"))


def vol_target(weights: DataFrame, returns: DataFrame, months: DataFrame, target: float = 0.15, cap: float = 2.0) -> DataFrame:
    """Weights times min(target / volatility, cap); the volatility is that of the last 12 (at least 6) costless returns, undefined: 1."""
    gross = backtest_monthly(returns, weights, months)
    sd = rolling(F.stddev_pop, "ret_gross", 12, W.orderBy("ord"), 6) * MONTHS**0.5
    scale = gross.select("ord", F.coalesce(F.least(ratio(F.lit(target), F.nullif(sd, F.lit(0.0))), F.lit(cap)), F.lit(1.0)).alias("_s"))
    return weights.join(F.broadcast(scale), "ord").withColumn("weight", F.col("weight") * F.col("_s")).drop("_s")


def equity_curve(rets: DataFrame, value: str = "ret_net", by: Sequence[str] = ()) -> DataFrame:
    """Adds ``equity`` (running product) and ``drawdown`` (from its running maximum, which starts after the first return)."""
    w = W.partitionBy(*by).orderBy("month")
    return rets.withColumn("equity", growth(F.coalesce(F.col(value), F.lit(0.0)), w)).withColumn("drawdown", drawdown(F.col("equity"), w))


def perf_stats(rets: DataFrame, bench: DataFrame | None = None, rf: DataFrame | None = None, value: str = "ret_net", by: Sequence[str] = ()) -> DataFrame:
    """CAGR, volatility, Sharpe over the policy rate, deepest drawdown, months; against a benchmark: tracking error and information ratio. ``bench`` and ``rf`` may be columns of ``rets``."""
    rows = equity_curve(rets.where(F.col(value).isNotNull()), value, by)
    for name, own in (("bench", bench), ("rf", rf)):  # a row a month
        if own is not None:
            rows = rows.drop(name).join(F.broadcast(own.select("month", name)), "month", "left")
        elif name not in rows.columns:
            rows = rows.withColumn(name, F.lit(None).cast("double"))
    excess, active = F.col(value) - F.coalesce("rf", F.lit(0.0)), F.col(value) - F.col("bench")
    out = rows.groupBy(*by).agg(
        F.count("*").alias("n_months"), F.max_by("equity", "month").alias("final"), F.stddev_pop(value).alias("sd"), F.avg(excess).alias("mean_excess"), F.stddev_pop(excess).alias("sd_excess"), F.min("drawdown").alias("max_dd"),
        F.avg(active).alias("mean_active"), F.stddev_pop(active).alias("sd_active"),
    )
    year = MONTHS**0.5
    return out.select(
        *by, F.when(F.col("final") > 0, F.pow("final", MONTHS / F.col("n_months")) - 1).alias("cagr"), (F.col("sd") * year).alias("vol"), (ratio(F.col("mean_excess"), F.nullif(F.col("sd_excess"), F.lit(0.0))) * year).alias("sharpe"), "max_dd", "n_months",
        (F.col("sd_active") * year).alias("te"), (ratio(F.col("mean_active"), F.nullif(F.col("sd_active"), F.lit(0.0))) * year).alias("ir"),
    )


def run_strategy(panel: DataFrame, lookback: int = 6, skip: int = 1, q: float = 0.2, hold: int = 3, tc_bps: float = 10.0, long_short: bool = False, top_n: int | None = 15, weighting: str = "equal", trend: DataFrame | None = None, target: float | None = None, missing: str = "exit") -> DataFrame:
    """Signal, weights, holding, gate, scaling and backtest; warm-up months are dropped."""
    months = panel.select("month", "ord").distinct()
    weights = rebalance_weights(momentum_signal(panel, lookback, skip), q=q, long_short=long_short, top_n=top_n, weighting=weighting)
    weights = apply_holding(weights, hold, months)
    weights = trend_gate(weights, trend) if trend is not None else weights
    weights = vol_target(weights, panel, months, target) if target else weights
    return backtest_monthly(panel, weights, months, tc_bps, missing).where(F.col("ord") > lookback + skip + 1)


def parameter_grid(spark, lookbacks: Sequence[int] = (3, 6, 9, 12), skips: Sequence[int] = (0, 1), holds: Sequence[int] = (1, 3, 6), quantiles: Sequence[float] = (0.2, 0.3), long_short: Sequence[bool] = (False, True)) -> DataFrame:  # noqa: ANN001
    """All combinations, numbered in nested order from 1: 96 by default."""
    grid = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in lookbacks])).alias("lookback"))
    for name, xs in (("skip", skips), ("hold", holds), ("q", quantiles), ("long_short", long_short)):
        grid = grid.select("*", F.explode(F.array(*[F.lit(x) for x in xs])).alias(name))
    return grid.withColumn("config", F.row_number().over(W.orderBy("lookback", "skip", "hold", "q", "long_short")))


def grid_returns(panel: DataFrame, grid: DataFrame, tc_bps: float = 10.0, top_n: int | None = None) -> DataFrame:
    """Monthly returns of every configuration, without its warm-up, in one plan.

    Signals are computed once for each distinct (lookback, skip), as columns of one panel, and weights once for each that differ; only the
    holding periods multiply rows.
    """
    months = panel.select("month", "ord").distinct()
    pairs = [(r.lookback, r.skip) for r in grid.select("lookback", "skip").distinct().orderBy("lookback", "skip").collect()]  # a parameter list
    entry = lambda lb, sk: F.struct(F.lit(lb).alias("lookback"), F.lit(sk).alias("skip"), (ratio(F.lag("px", sk).over(by_month()), F.lag("px", lb + sk).over(by_month())) - 1).alias("mom"))
    signals = panel.withColumn("_all", F.array(*[entry(*p) for p in pairs])).withColumn("_s", F.explode("_all")).select("ticker", "month", "ord", "turnover", "vol", "_s.*").where("mom is not null")
    legs = grid.select("lookback", "skip", "q", "long_short").distinct()
    rows = signals.join(F.broadcast(legs), ["lookback", "skip"])
    key = ["lookback", "skip", "q", "long_short"]
    weights = rebalance_weights(rows, by=[*key, "month"], q=F.col("q"), long_short=F.col("long_short"), top_n=top_n)
    held = apply_holding(weights.join(F.broadcast(grid), key), F.col("hold"), months, by=["config"])
    rets = backtest_monthly(panel, held, months, tc_bps, by=["config"])
    warm = grid.select("config", (F.col("lookback") + F.col("skip") + 1).alias("_warm"))
    return rets.join(F.broadcast(warm), "config").where("ord > _warm").drop("_warm")


def grid_parts(panel: DataFrame, bench: DataFrame, grid: DataFrame, train: float = 0.6, tc_bps: float = 10.0, rf: DataFrame | None = None) -> DataFrame:
    """``grid_returns`` with ``bench``, ``rf`` and ``part``: ``train`` up to the split of the months that all have in common, ``test`` after it.

    A table of configurations by months, written once: what is asked of it reads it again, not the panel.
    """
    rets = durable(grid_returns(panel, grid, tc_bps), "grid-returns")
    common = rets.select("month").distinct().join(bench.where("bench is not null").select("month", "bench"), "month")  # a row a month
    common = common.withColumn("_at", F.row_number().over(W.orderBy("month"))).withColumn("_n", F.count("*").over(W.partitionBy()))
    common = common.join(rf.select("month", "rf"), "month", "left") if rf is not None else common.withColumn("rf", F.lit(None).cast("double"))
    common = common.withColumn("part", F.when(F.col("_at") <= F.floor(F.col("_n") * train), "train").otherwise("test")).drop("_at", "_n")
    return durable(rets.join(F.broadcast(common), "month"), "grid-parts")


def walk_forward(parts: DataFrame, grid: DataFrame, objective: str = "sharpe") -> DataFrame:
    """Every configuration's statistics in both ``parts``, with ``chosen``: the first best in training."""
    stats = perf_stats(parts, by=["config", "part"])
    figures = ("cagr", "vol", "sharpe", "max_dd", "n_months", "te", "ir")
    sides = stats.groupBy("config").agg(F.count_if(F.col("part") == "train").alias("_trained"), *[F.max(F.when(F.col("part") == p, F.col(c))).alias(f"{p}_{c}") for p in ("train", "test") for c in figures])
    out = grid.join(sides.where("_trained > 0").drop("_trained"), "config")
    best = F.row_number().over(W.orderBy(F.col(f"train_{objective}").desc_nulls_last(), "config")) == 1
    return out.withColumn("chosen", best)


def out_of_sample(parts: DataFrame, walked: DataFrame) -> DataFrame:
    """``month, equity, bench_equity`` of the chosen configuration after the split, both growing from 1."""
    own = parts.where("part = 'test'").join(F.broadcast(walked.where("chosen").select("config")), "config")  # one row
    w = W.orderBy("month")  # a row a month
    return own.select("month", growth(F.col("ret_net"), w).alias("equity"), growth(F.col("bench"), w).alias("bench_equity"))


def robustness(walked: DataFrame, holds: Sequence[int] = (1, 3, 6)) -> DataFrame:
    """Mean test Sharpe by lookback (rows) and holding period (columns)."""
    return walked.groupBy("lookback").pivot("hold", list(holds)).agg(F.avg("test_sharpe"))


def calendar_table(rets: DataFrame, value: str = "ret_net") -> DataFrame:
    """Year by month returns, and the year compounded."""
    own = rets.where(F.col(value).isNotNull()).withColumn("year", F.year("month")).withColumn("m", F.month("month"))
    table = own.groupBy("year").pivot("m", list(range(1, 13))).agg(F.first(value))
    return table.select("year", *[F.col(str(m)).alias(f"m{m:02d}") for m in range(1, 13)]).join(own.groupBy("year").agg((F.product(1 + F.col(value)) - 1).alias("total")), "year")


def composition(weights: DataFrame, panel: DataFrame, sectors: DataFrame, month: str, signal: str = "mom") -> DataFrame:
    """The portfolio of a month with signal, volatility, sector, and what it returned in the next."""
    at = F.lit(month).cast("date")
    nxt = panel.select("ticker", F.col("ord").alias("_next"), F.col("ret").alias("next_ret"))
    own = weights.where((F.col("month") == at) & (F.col("weight") != 0)).select("ticker", "ord", "weight")
    out = own.join(panel.where(F.col("month") == at).select("ticker", signal, "vol"), "ticker", "left").join(sectors, "ticker", "left").join(nxt, (own["ticker"] == nxt["ticker"]) & (F.col("_next") == F.col("ord") + 1), "left").drop(nxt["ticker"])
    return out.select("ticker", "weight", signal, "vol", F.coalesce("sector", F.lit("other")).alias("sector"), "next_ret")
