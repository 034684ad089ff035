"""Registered queries over the derived market tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import core, intervals, quantiles, ranks, series
from ..operators import backtest as bt
from ..operators import bonds as bd
from ..operators import corporate_actions as ca
from ..operators import performance as pf
from ..operators import portfolio as po
from ..operators import risk as rk
from ..operators import timeseries as ts
from ..schemas import BOND_BARS, INDEX_BARS, MONTHS, RENAMES, SECTORS
from ..scratch import durable, scratch_path
from ..sources import market as mk
from ..sources import synthetic as sy
from ..streaming import market as sm
from .oracle import r6 as R
from .oracle import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: The trailing period and the anchor of the market queries; the parts of the SQL hold the same.
PERIOD, ANCHOR = "3m", "1999-12-30"
#: Numbers of bonds to a page of the bond table.
PAGE_BONDS = 500


def query(name: str, oracle: str | None = None, **parts: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = sql(oracle, **parts)
        return f

    return register


def r6(x: Column | str, name: str | None = None) -> Column:
    """Six decimals, ten digits of numbers from a million on (just more than half up), null for NaN: by expressions that both engines evaluate alike."""
    x = F.nanvl((F.col(x) if isinstance(x, str) else x).cast("double"), F.lit(None).cast("double"))
    out = F.when(F.abs(x) < 1e6, F.floor(x * 1e6 + 0.5) / 1e6).when(x.isNotNull(), F.format_string("%.9e", x * (1 + 2e-12)).cast("double"))
    return out.alias(name) if name else out


def r6s(*names: str) -> list[Column]:
    return [r6(n, n) for n in names]


def Rs(*names: str) -> str:  # noqa: N802
    return ", ".join(f"{R(n)} AS {n}" for n in names)


def big(*names: str) -> list[Column]:
    return [F.col(n).cast("long").alias(n) for n in names]


# ---------------------------------------------------------------- sources


_UPSERT = "SELECT ticker, date, close * 1.01 AS close FROM bars WHERE date >= DATE '2000-12-01' UNION ALL SELECT ticker, date, close FROM bars WHERE date < DATE '2000-12-01'"


def _stored(spark, df, **how):
    """A table of the engine's own, in the shared scratch folder."""
    path = scratch_path(spark, "stored")
    mk.write_bars(df, path, **how)
    return path


def _bar_columns(spark, d):
    return sy.bars(spark, d).select("ticker", "date", F.lit(None).cast("double").alias("open"), "low", "high", "close", "waprice", "value_rub", "volume")


@query("a1_read_bars", f"SELECT ticker, date, {Rs('close', 'value_rub')}, volume FROM bars WHERE ticker IN ('Brand#11', 'Brand#12') AND date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'")
def _(spark, d):
    rows = mk.read_bars(spark, _stored(spark, _bar_columns(spark, d)), ["Brand#11", "Brand#12"], "1997-01-01", "1998-12-31")
    return rows.select("ticker", "date", *r6s("close", "value_rub"), "volume")


@query("a2_stored_bars_scan", """SELECT CASE WHEN ticker IN ('Brand#21', 'Brand#22') THEN 'Brand#23' ELSE ticker END AS ticker, CAST(count(*) AS BIGINT) AS n, min(date) AS first_date, max(date) AS last_date FROM bars
       WHERE NOT (ticker = 'Brand#21' AND date >= DATE '1998-01-02') AND NOT (ticker = 'Brand#22' AND date >= DATE '2000-01-03') GROUP BY 1""")
def _(spark, d):
    rows = mk.read_all(spark, _stored(spark, _bar_columns(spark, d)), sy.renames(spark))
    return rows.groupBy("ticker").agg(F.count("*").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query("a3_read_index", f"SELECT 'INDEX' AS ticker, date, {R('close')} AS close FROM idx")
def _(spark, d):
    return mk.read_one(spark, _stored(spark, sy.index_bars(spark, d)), "ticker", "INDEX", INDEX_BARS).select("ticker", "date", r6("close", "close"))


@query("a4_read_bond", f"SELECT secid, tradedate, {R('close')} AS close FROM bonds WHERE secid = 'B1'")
def _(spark, d):
    path = _stored(spark, sy.bond_bars(spark, d).withColumn("waprice", F.col("close")), key="secid", date="tradedate")
    return mk.read_one(spark, path, "secid", "B1", BOND_BARS).select("secid", "tradedate", r6("close", "close"))


def _landed_csv(spark, df):
    path = scratch_path(spark, "landed-csv")
    mk.write_csv(df, path)
    return path


@query("a7_rename_registry", "SELECT r.old, r.new, r.date, CAST(count(b.date) AS BIGINT) AS bars_before FROM renames r LEFT JOIN bars b ON b.ticker = r.old AND b.date < r.date GROUP BY 1, 2, 3")
def _(spark, d):
    renames = mk.registry(spark, _landed_csv(spark, sy.renames(spark)), RENAMES)
    px = sy.bars(spark, d).select(F.col("ticker").alias("t"), F.col("date").alias("b"))
    return renames.join(px, (F.col("old") == F.col("t")) & (F.col("b") < F.col("date")), "left").groupBy("old", "new", "date").agg(F.count("b").alias("bars_before"))


@query("a9_sector_map", "SELECT coalesce(sector, 'other') AS sector, CAST(count(*) AS BIGINT) AS bars FROM bars b LEFT JOIN sectors s ON s.ticker = b.ticker GROUP BY 1")
def _(spark, d):
    return pf.with_sector(sy.bars(spark, d), mk.registry(spark, _landed_csv(spark, sy.sectors(spark, d)), SECTORS)).groupBy("sector").agg(F.count("*").alias("bars"))


@query("a15_bond_list", "SELECT 'B' || p_partkey AS secid, p_name AS shortname, 1000.0::DOUBLE AS facevalue, CAST(p_size % 13 AS DOUBLE) AS couponpercent, mat AS matdate FROM part JOIN bparams ON secid = 'B' || p_partkey WHERE p_size % 3 = 0")
def _(spark, d):
    return mk.bond_list(_bond_payloads(spark, d), "TQCB")


@query("a15_bond_params", "SELECT secid, face AS facevalue, coupon AS couponpercent, mat AS matdate FROM bparams")
def _(spark, d):
    return mk.bond_params(_bond_payloads(spark, d))


def _bond_payloads(spark, d):
    """The bond table as the exchange sends it, in pages: documents don't grow with the table."""
    names = sy.read(spark, d, "part").select(F.floor(F.col("p_partkey") / PAGE_BONDS).alias("page"), F.concat(F.lit("B"), F.col("p_partkey")).alias("secid"), F.col("p_name").alias("name"), F.when(F.col("p_size") % 3 == 0, "TQCB").otherwise("TQOB").alias("board"))
    text = sy.bond_params(spark, d).join(names, "secid").select("page", F.array("secid", "name", "board", F.col("facevalue").cast("string"), F.col("couponpercent").cast("string"), F.col("matdate").cast("string")).alias("r"))
    heads = F.array(*[F.lit(c) for c in ("SECID", "SHORTNAME", "BOARDID", "FACEVALUE", "COUPONPERCENT", "MATDATE")])
    docs = text.groupBy("page").agg(F.struct(heads.alias("columns"), F.collect_list("r").alias("data")).alias("securities"))
    return docs.select(F.to_json(F.struct("securities")).alias("payload"))


@query("a17_replace_table", f"SELECT ticker, date, {R('close')} AS close FROM ({_UPSERT})")
def _(spark, d):
    stored, landed = _stored_and_landed(spark, d)
    path = _stored(spark, stored.select("ticker", "date", "close"))
    before = mk.read_bars(spark, path, schema="ticker string, date date, close double")
    mk.write_bars(mk.upsert(before, landed.select("ticker", "date", "close")), path)  # reads the table that it replaces
    return mk.read_bars(spark, path, schema="ticker string, date date, close double").select("ticker", "date", r6("close", "close"))


@query("a19_update_all", f"SELECT ticker, date, {R('close')} AS close FROM ({_UPSERT}) WHERE ticker <> 'Brand#13' UNION ALL SELECT ticker, date, {R('close')} FROM bars WHERE ticker = 'Brand#13' AND date <= DATE '2000-12-31'")
def _(spark, d):
    stored, landed = _stored_and_landed(spark, d)
    broken = (F.col("ticker") == "Brand#13") & (F.dayofmonth("date") == 5)
    text = landed.select("ticker", F.col("date").cast("string").alias("date"), F.when(broken, "n/a").otherwise(F.col("close").cast("string")).alias("close"))
    return mk.update_all(stored.select("ticker", "date", "close"), text)[0].select("ticker", "date", r6("close", "close"))


@query("a22_csv_export", "SELECT ticker, CAST(count(*) AS BIGINT) AS n, min(date) AS first_date, max(date) AS last_date FROM bars GROUP BY 1")
def _(spark, d):
    path = _landed_csv(spark, sy.bars(spark, d).select("ticker", "date", "close"))
    return mk.registry(spark, path, "ticker string, date date, close double").groupBy("ticker").agg(F.count("date").alias("n"), F.min("date").alias("first_date"), F.max("date").alias("last_date"))


@query("a5_shares_snapshots", "SELECT s.ticker, CAST(count(DISTINCT s.date) AS BIGINT) AS snapshots, CAST(count(b.date) AS BIGINT) AS bars_on_snapshot FROM shares s LEFT JOIN bars b ON b.ticker = s.ticker AND b.date = s.date GROUP BY 1")
def _(spark, d):
    sheets = sy.shares(spark, d).select(F.date_format("date", "dd.MM.yyyy").alias("sheet"), "ticker", "shares").unionByName(sy.tickers(spark, d).select(F.lit("notes").alias("sheet"), "ticker", F.lit(1.0).alias("shares")))
    snaps = mk.load_shares(sheets)
    return snaps.join(sy.bars(spark, d).select("ticker", "date", "close"), ["ticker", "date"], "left").groupBy("ticker").agg(F.count_distinct("date").alias("snapshots"), F.count("close").alias("bars_on_snapshot"))


@query("a6_splits_registry", """SELECT s.ticker, s.date, s.ratio, s.kind, CAST((SELECT count(*) FROM bars b WHERE b.ticker = s.ticker AND b.date < s.date) AS BIGINT) AS bars_before
       FROM (SELECT * FROM splits UNION ALL SELECT 'Brand#14', DATE '2000-07-15', 1.0 / 5000, 'auto') s""")
def _(spark, d):
    splits = mk.load_splits(sy.splits(spark), sy.split_json(spark))
    px = sy.bars(spark, d).select(F.col("ticker").alias("t"), F.col("date").alias("b"))
    return splits.join(px, (F.col("ticker") == F.col("t")) & (F.col("b") < F.col("date")), "left").groupBy("ticker", "date", "ratio", "kind").agg(F.count("b").alias("bars_before"))


@query("a8_rate_in_force", "SELECT c.date, coalesce(k.rate, (SELECT arg_min(rate, date) FROM key_rate)) AS rate FROM cal c ASOF LEFT JOIN key_rate k ON c.date >= k.date")
def _(spark, d):
    days = sy.index_bars(spark, d).select("date")
    return core.asof_join(days, sy.key_rate(spark).withColumnRenamed("date", "since"), [], "date", "since", ["rate"], backfill=True)


@query("a10_dividends", "SELECT ticker, CAST(count(*) AS BIGINT) AS n, sum(dividend_value) AS total FROM dividends d WHERE EXISTS (SELECT 1 FROM bars b WHERE b.ticker = d.ticker AND b.date = d.closing_date) GROUP BY 1")
def _(spark, d):
    divs = mk.positive_dividends(sy.dividends(spark, d)).withColumn("date", F.col("closing_date"))
    return divs.join(sy.bars(spark, d), ["ticker", "date"], "left_semi").groupBy("ticker").agg(F.count("*").alias("n"), F.sum("dividend_value").alias("total"))


@query("a11_exchange_tables", "SELECT secid, CAST(count(*) AS BIGINT) AS n, " + R("sum(close)") + " AS total FROM bonds GROUP BY 1")
def _(spark, d):
    rows = sy.bond_bars(spark, d).select("secid", F.array(F.col("tradedate").cast("string"), F.col("close").cast("string")).alias("r"))
    table = F.struct(F.array(F.lit("TRADEDATE"), F.lit("CLOSE")).alias("columns"), F.collect_list("r").alias("data"))
    docs = rows.groupBy("secid").agg(F.to_json(F.struct(table.alias("history"))).alias("payload"))
    out = mk.parse_tables(docs, "history", ["TRADEDATE", "CLOSE"], keep=["secid"])
    return out.groupBy("secid").agg(F.count("tradedate").alias("n"), r6(F.sum(F.col("close").cast("double")), "total"))


@query("a12_main_board", f"SELECT ticker, date, {Rs('close', 'value_rub')} FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY value_rub DESC, boardid) AS rn FROM boards) WHERE rn = 1")
def _(spark, d):
    return mk.main_board(sy.multi_board_history(spark, d)).select("ticker", "date", *r6s("close", "value_rub"))


def _candles(frequency: int, start: str) -> tuple[str, Query]:
    body = f"""SELECT user_id, strftime({start}, '%Y-%m-%d %H:%M:%S') AS begin, {R('first(value ORDER BY ts, event_id)')} AS open, {R('max(value)')} AS high, {R('min(value)')} AS low, {R('last(value ORDER BY ts, event_id)')} AS close,
        {R('sum(value)')} AS value_rub, CAST(count(value) AS BIGINT) AS n FROM events GROUP BY user_id, {start}"""

    def run(spark, d):
        c = mk.resample_candles(sy.events(spark, d), frequency, key="user_id", price="value", order="event_id")
        return c.select("user_id", F.date_format("begin", "yyyy-MM-dd HH:mm:ss").alias("begin"), *r6s("open", "high", "low", "close", "value_rub"), "n")

    return body, run


for _f, _start in ((1, "time_bucket(INTERVAL 1 MINUTE, ts)"), (10, "time_bucket(INTERVAL 10 MINUTE, ts)"), (60, "date_trunc('hour', ts)"), (24, "date_trunc('day', ts)"), (7, "date_trunc('week', ts)"), (31, "date_trunc('month', ts)"), (4, "date_trunc('quarter', ts)")):
    _body, _run = _candles(_f, _start)
    query(f"a13_candles_{_f}", _body)(_run)


@query("a14_index_history", f"SELECT 'INDEX' AS ticker, date, {Rs('close', 'volume')} FROM idx")
def _(spark, d):
    raw = sy.index_bars(spark, d).select(F.col("date").cast("string").alias("TRADEDATE"), F.col("volume").alias("VALUE"), F.col("close").alias("CLOSE"))
    return mk.index_history(raw, "INDEX").select("ticker", "date", *r6s("close", "volume"))


@query("a16_bond_pages", """SELECT secid, tradedate, close FROM (SELECT *, row_number() OVER (PARTITION BY secid, tradedate ORDER BY page_offset DESC) AS rn
       FROM (SELECT 'B' || l_partkey AS secid, CAST(l_shipdate AS DATE) AS tradedate, l_orderkey AS page_offset, max(l_quantity) AS close FROM lineitem GROUP BY 1, 2, 3)) WHERE rn = 1""")
def _(spark, d):
    pages = sy.read(spark, d, "lineitem").groupBy(F.concat(F.lit("B"), "l_partkey").alias("secid"), F.to_date("l_shipdate").alias("tradedate"), F.col("l_orderkey").alias("page_offset")).agg(F.max("l_quantity").alias("close"))
    return mk.bond_history(pages.withColumn("row_pos", F.lit(0)).withColumn("waprice", F.col("close"))).select("secid", "tradedate", "close")




def _stored_and_landed(spark, d):
    bars = sy.bars(spark, d)
    return bars.where("date <= DATE '2000-12-31'"), bars.where("date >= DATE '2000-12-01'").withColumn("close", F.col("close") * 1.01)


@query("a18_upsert", f"SELECT ticker, date, {R('close')} AS close FROM ({_UPSERT})")
def _(spark, d):
    return mk.upsert(*_stored_and_landed(spark, d)).select("ticker", "date", r6("close", "close"))


_CLOSES = "ticker string, date date, close double"


@query("a18_upsert_table", f"SELECT ticker, date, {R('close')} AS close FROM ({_UPSERT})")
def _(spark, d):
    stored, landed = _stored_and_landed(spark, d)
    path = scratch_path(spark, "table")
    mk.upsert_table(spark, path, stored.select("ticker", "date", "close"), _CLOSES)
    mk.upsert_table(spark, path, landed.select("ticker", "date", "close"), _CLOSES)
    return mk.read_bars(spark, path, schema=_CLOSES).select("ticker", "date", r6("close", "close"))


@query("a19_update_table", f"SELECT ticker, date, {R('close')} AS close FROM ({_UPSERT}) WHERE ticker <> 'Brand#13' UNION ALL SELECT ticker, date, {R('close')} FROM bars WHERE ticker = 'Brand#13' AND date <= DATE '2000-12-31'")
def _(spark, d):
    stored, landed = _stored_and_landed(spark, d)
    path = scratch_path(spark, "table")
    mk.upsert_table(spark, path, stored.select("ticker", "date", "close"), _CLOSES)
    broken = (F.col("ticker") == "Brand#13") & (F.dayofmonth("date") == 5)
    mk.update_table(spark, path, landed.select("ticker", F.col("date").cast("string").alias("date"), F.when(broken, "n/a").otherwise(F.col("close").cast("string")).alias("close")), _CLOSES)
    return mk.read_bars(spark, path, schema=_CLOSES).select("ticker", "date", r6("close", "close"))


@query("i2_streamed_upsert", f"SELECT ticker, date, {R('close')} AS close FROM ({_UPSERT})")
def _(spark, d):
    """Stored bars and corrections land as files and are streamed into one table, a batch each."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "table")
    for k, df in enumerate(_stored_and_landed(spark, d)):
        df.select("ticker", "date", "close").write.mode("append").parquet(landing)
        stream = spark.readStream.schema(_CLOSES).parquet(landing)
        sm.stream_upsert(stream, path, f"{path}-checkpoint", _CLOSES).awaitTermination()
    return mk.read_bars(spark, path, schema=_CLOSES).select("ticker", "date", r6("close", "close"))


@query("i1_streamed_candles", f"""SELECT user_id AS ticker, time_bucket(INTERVAL 10 MINUTE, ts) AS begin, {R('arg_min(value, (ts, event_id))')} AS open, {R('max(value)')} AS high, {R('min(value)')} AS low, {R('arg_max(value, (ts, event_id))')} AS close, CAST(count(value) AS BIGINT) AS n FROM events GROUP BY 1, 2""")
def _(spark, d):
    """Candles of a stream of trades, written as their windows close; a last row far ahead moves the watermark past all others."""
    trades = sy.events(spark, d).select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value", "event_id")
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "candles")
    trades.write.parquet(landing)
    stream = spark.readStream.schema(trades.schema).parquet(landing)
    for _ in range(2):
        candles = sm.stream_candles(stream, late="3650 days", key="user_id", price="value", order="event_id")
        candles.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-checkpoint").trigger(availableNow=True).start().awaitTermination()
        ahead = trades.groupBy().agg(F.lit(-1).cast("long").alias("user_id"), F.timestamp_add("YEAR", F.lit(20), F.max("ts")).alias("ts"), F.lit(0.0).alias("value"), F.lit(-1).cast("long").alias("event_id"))
        ahead.write.mode("append").parquet(landing)
    rows = spark.read.parquet(out).where("user_id >= 0")
    return rows.select(F.col("user_id").alias("ticker"), F.col("begin").cast("timestamp_ntz").alias("begin"), *r6s("open", "high", "low", "close"), "n")


@query("a18_fetch_from", "SELECT ticker, CAST(max(date) + 1 AS DATE) AS since FROM bars WHERE date <= DATE '2000-12-31' GROUP BY 1")
def _(spark, d):
    return mk.last_dates(_stored_and_landed(spark, d)[0], next_day=True)


@query("a20_list_tickers", "SELECT DISTINCT ticker FROM bars WHERE ticker NOT IN (SELECT old FROM renames)")
def _(spark, d):
    return mk.list_tickers(sy.bars(spark, d), sy.renames(spark))


@query("k72_refresh", f"SELECT c.ticker, c.date, {R('c.close')} AS close, {R('t.adj_close')} AS adj_close, {Rs('shares', 'market_cap')} FROM cap c JOIN tr t ON t.ticker = c.ticker AND t.date = c.date",
       bars="SELECT * REPLACE (CASE WHEN date >= DATE '2000-12-01' THEN close * 1.01 ELSE close END AS close) FROM bars_0")
def _(spark, d):
    stored, landed = _stored_and_landed(spark, d)
    out = mk.refresh(stored, landed, sy.splits(spark), sy.dividends(spark, d), sy.shares(spark, d))
    return out.select("ticker", "date", *r6s("close", "adj_close", "shares", "market_cap"))


# ---------------------------------------------------------------- filters, joins, aggregates


@query("b4_periods", "SELECT code, s AS start, e AS \"end\" FROM (SELECT max(date) AS e, min(date) AS lo FROM bars), (VALUES ('1d'), ('1w'), ('1m'), ('6m'), ('1y'), ('3y'), ('ytd'), ('all')) AS c(code), "
       "LATERAL (SELECT CASE code WHEN '1d' THEN (SELECT min(date) FROM (SELECT DISTINCT date FROM bars ORDER BY date DESC LIMIT 2)) WHEN '1w' THEN e - 7 WHEN '1m' THEN CAST(e - INTERVAL 1 MONTH AS DATE) WHEN '6m' THEN CAST(e - INTERVAL 6 MONTH AS DATE) "
       "WHEN '1y' THEN CAST(e - INTERVAL 1 YEAR AS DATE) WHEN '3y' THEN CAST(e - INTERVAL 3 YEAR AS DATE) WHEN 'ytd' THEN make_date(year(e), 1, 1) ELSE lo END AS s)")
def _(spark, d):
    bars = sy.bars(spark, d)
    out = None
    for code in ("1d", "1w", "1m", "6m", "1y", "3y", "ytd", "all"):
        one = pf.period_bounds(bars, code).select(F.lit(code).alias("code"), "start", "end")
        out = one if out is None else out.unionByName(one)
    return out


@query("b6_valid_prices", "SELECT ticker, CAST(count(*) AS BIGINT) AS n FROM bars JOIN (SELECT ticker AS t, median(volume) AS mid FROM bars GROUP BY 1) ON ticker = t WHERE volume > 0 AND volume BETWEEN 0.5 * mid AND 2 * mid GROUP BY 1")
def _(spark, d):
    return rk.valid_prices(sy.bars(spark, d), "volume", 0.5, 2.0).groupBy("ticker").agg(F.count("*").alias("n"))


@query("b8_complete_history", "SELECT ticker, CAST(count(*) AS BIGINT) AS n FROM bars WHERE ticker IN (SELECT ticker FROM bars GROUP BY 1 HAVING min(date) <= DATE '1995-01-01' + 30 AND max(date) >= (SELECT max(date) FROM bars) - 30) GROUP BY 1")
def _(spark, d):
    return rk.complete_tickers(sy.bars(spark, d), "1995-01-01").groupBy("ticker").agg(F.count("*").alias("n"))


@query("b10_valid_codes", "SELECT ticker, CAST(count(*) AS BIGINT) AS n FROM bars WHERE regexp_matches(ticker, '^Brand#[0-9]$') GROUP BY 1")
def _(spark, d):
    return sy.bars(spark, d).where(F.col("ticker").rlike("^Brand#[0-9]$")).groupBy("ticker").agg(F.count("*").alias("n"))


@query("c4_asof_by_union", "SELECT b.ticker, b.date, s.shares FROM bars b ASOF LEFT JOIN shares s ON b.ticker = s.ticker AND b.date >= s.date")
def _(spark, d):
    return core.asof_by_union(sy.bars(spark, d).select("ticker", "date"), sy.shares(spark, d), ["ticker"], "date", "date", ["shares"])


@query("c4_asof_tape", """SELECT e.event_id, r.event_id AS before_id, r.value AS before_value FROM (SELECT event_id, ts FROM events WHERE event_id % 2 = 0) e
       ASOF LEFT JOIN (SELECT ts, arg_max(event_id, (value, event_id)) AS event_id, max(value) AS value FROM events WHERE event_id % 2 = 1 GROUP BY 1) r ON e.ts > r.ts""")
def _(spark, d):
    """Each trade of one side of the tape with the last of the other before it: two long sides without a key."""
    tape = sy.events(spark, d).select("event_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    odd = tape.where("event_id % 2 = 1").select("ts", F.col("value").alias("before_value"), F.col("event_id").alias("before_id"))
    out = intervals.asof_in_stretches(tape.where("event_id % 2 = 0"), odd, [], "ts", "ts", ["before_value", "before_id"], inclusive=False, stretch="hour")
    return out.select("event_id", "before_id", "before_value")


@query("c6_splits_near_dividends", "SELECT s.ticker, s.date, d.closing_date, d.dividend_value FROM splits s JOIN dividends d ON d.ticker = s.ticker AND abs(date_diff('day', s.date, d.closing_date)) <= 90")
def _(spark, d):
    near = intervals.near_join(sy.splits(spark), sy.dividends(spark, d), ["ticker"], "date", "closing_date", 90)
    return near.select("ticker", "date", "closing_date", "dividend_value")


@query("d15_describe", "SELECT 'close' AS \"column\", CAST(count(close) AS BIGINT) AS count, " + ", ".join(f"{R(x)} AS {n}" for x, n in (("avg(close)", "mean"), ("stddev_samp(close)", "std"), ("min(close)", "min"), ("quantile_cont(close, 0.25)", "p25"), ("quantile_cont(close, 0.5)", "p50"), ("quantile_cont(close, 0.75)", "p75"), ("max(close)", "max"))) + " FROM bars")
def _(spark, d):
    return rk.describe(sy.bars(spark, d), "close").select("column", "count", *r6s("mean", "std", "min", "p25", "p50", "p75", "max"))


@query("d7_price_percentiles", "SELECT ticker, " + ", ".join(f"{R(f'quantile_cont(close, {p})')} AS p{int(p * 100)}" for p in (0.05, 0.5, 0.95)) + " FROM bars GROUP BY 1")
def _(spark, d):
    found = quantiles.exact_percentiles(_bars(spark, d), "close", (0.05, 0.5, 0.95), ["ticker"])
    return found.select("ticker", *[r6(F.get("percentiles", F.lit(i)), n) for i, n in enumerate(("p5", "p50", "p95"))])


@query("d7_line_percentiles", "SELECT l_returnflag, " + ", ".join(f"{R(f'quantile_cont(l_extendedprice, {p})')} AS p{int(p * 100)}" for p in (0.01, 0.25, 0.5, 0.99)) + " FROM lineitem GROUP BY 1")
def _(spark, d):
    """Three groups that hold all lines: more values than a task sorts."""
    found = quantiles.exact_percentiles(sy.read(spark, d, "lineitem"), "l_extendedprice", (0.01, 0.25, 0.5, 0.99), ["l_returnflag"])
    return found.select("l_returnflag", *[r6(F.get("percentiles", F.lit(i)), n) for i, n in enumerate(("p1", "p25", "p50", "p99"))])


_PARTS = "parts AS (SELECT 'P' || l_partkey AS ticker, last_day(CAST(l_shipdate AS DATE)) AS month, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS turnover FROM lineitem GROUP BY 1, 2)"


def _part_months(spark, d):
    """Monthly turnover with a security for each part: a universe that grows with the tables."""
    turnover = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("turnover")
    return sy.read(spark, d, "lineitem").groupBy(F.concat(F.lit("P"), F.col("l_partkey")).alias("ticker"), F.last_day(F.col("l_shipdate").cast("date")).alias("month")).agg(turnover)


@query("e9_wide_ranks", f"""WITH RECURSIVE {_PARTS} SELECT ticker, month, {R('(rank() OVER (PARTITION BY month ORDER BY turnover) + (count(*) OVER (PARTITION BY month, turnover) - 1) / 2.0) / count(*) OVER (PARTITION BY month)')} AS pct FROM parts""")
def _(spark, d):
    return ranks.large_pct_ranks(durable(_part_months(spark, d), "part-months"), "turnover", ["month"], "pct").select("ticker", "month", r6("pct", "pct"))


@query("e10_wide_top", f"""WITH RECURSIVE {_PARTS} SELECT ticker, month, {R('turnover')} AS turnover FROM (SELECT *, row_number() OVER (PARTITION BY month ORDER BY turnover DESC, ticker) AS i, greatest(1, floor(count(*) OVER (PARTITION BY month) * 0.1)) AS k FROM parts) WHERE i <= k""")
def _(spark, d):
    return ranks.large_top(durable(_part_months(spark, d), "part-months"), "turnover", ["month"], share=0.1).select("ticker", "month", r6("turnover", "turnover"))


@query("d18_histogram", f"""SELECT ticker, CAST(bin AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS n FROM (SELECT l.ticker, least(floor((ret - lo) / ((hi - lo) / 60)), 59) AS bin FROM lret l JOIN (SELECT ticker, min(ret) AS lo, max(ret) AS hi, stddev_samp(ret) AS sd FROM lret GROUP BY 1) m ON l.ticker = m.ticker WHERE hi > lo AND sd > 0) GROUP BY 1, 2""")
def _(spark, d):
    return rk.histogram(ts.log_returns(sy.bars(spark, d)), "ret").select("ticker", *big("bin"), "n")


@query("e2_rolling_means", f"SELECT ticker, date, {R('CASE WHEN count(px) OVER w >= 50 THEN avg(px) OVER w END')} AS ma50 FROM dense WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS 49 PRECEDING)")
def _(spark, d):
    return pf.dense_closes(sy.bars(spark, d)).select("ticker", "date", r6(core.rolling(F.avg, "px", 50, pf.by_date()), "ma50"))


_TAPE = "tape AS (SELECT event_id, value, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS i FROM events)"


def _tape(spark, d):
    """All trades as one series, which grows with the tables."""
    return sy.events(spark, d).select(F.lit("all").alias("ticker"), F.col("ts").cast("timestamp").alias("ts"), "event_id", "value")


@query("e2_tape_rolling", f"""WITH RECURSIVE {_TAPE}, r AS (SELECT *, value - lag(value) OVER (ORDER BY i) AS step FROM tape)
       SELECT event_id, {R('CASE WHEN count(value) OVER (ORDER BY i ROWS 199 PRECEDING) >= 200 THEN avg(value) OVER (ORDER BY i ROWS 199 PRECEDING) END')} AS mean_200,
              {R('CASE WHEN count(step) OVER (ORDER BY i ROWS 49 PRECEDING) >= 25 THEN stddev_samp(step) OVER (ORDER BY i ROWS 49 PRECEDING) END')} AS sd_50 FROM r""")
def _(spark, d):
    columns = {"step": lambda w: F.col("value") - F.lag("value").over(w), "mean_200": lambda w: core.rolling(F.avg, "value", 200, w), "sd_50": lambda w: core.rolling(F.stddev_samp, "step", 50, w, 25)}
    return series.rolling_blocks(_tape(spark, d), columns, 200, time="ts", then=["event_id"], chunk="hour", block=2_000).select("event_id", *r6s("mean_200", "sd_50"))


def _forgetting(span: int) -> str:
    return f"SELECT a.event_id, sum(b.value * CASE WHEN b.i = 0 THEN 1 ELSE 2.0 / {span + 1} END * pow(1 - 2.0 / {span + 1}, a.i - b.i)) AS ewma_{span} FROM tape a JOIN tape b ON b.i BETWEEN a.i - {21 * span} AND a.i GROUP BY 1"


@query("e7_tape_ewma", f"WITH RECURSIVE {_TAPE} SELECT event_id, {R('ewma_16')} AS ewma_16, {R('ewma_64')} AS ewma_64 FROM ({_forgetting(16)}) JOIN ({_forgetting(64)}) USING (event_id)")
def _(spark, d):
    out = series.ewma(_tape(spark, d), "value", (16, 64), time="ts", then=["event_id"], chunk="hour", block=8_000)
    return out.select("event_id", *r6s("ewma_16", "ewma_64"))


@query("e7_ewma", "SELECT ticker, " + ", ".join(f"{R(f'list_reduce(list(close ORDER BY date), lambda acc, x: acc * (1 - 2.0 / {s + 1}) + x * (2.0 / {s + 1}))')} AS ewma_{s}" for s in (16, 64)) + " FROM bars GROUP BY 1")
def _(spark, d):
    return sy.bars(spark, d).groupBy("ticker").agg(*[r6(core.ewma_last(F.col("close"), F.col("date"), s), f"ewma_{s}") for s in (16, 64)])


@query("e14_fill", f"SELECT ticker, date, {R('coalesce(last_value(px IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date), first_value(px IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))')} AS px FROM dense")
def _(spark, d):
    return pf.filled_closes(sy.bars(spark, d)).select("ticker", "date", r6("px", "px"))


@query("e15_year_extremes", f"SELECT ticker, date, {R('max(close) OVER w')} AS high_1y, {R('min(close) OVER w')} AS low_1y FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date RANGE BETWEEN INTERVAL 1 YEAR PRECEDING AND CURRENT ROW)")
def _(spark, d):
    return pf.year_extremes(sy.bars(spark, d)).select("ticker", "date", *r6s("high_1y", "low_1y"))


@query("f2_leaders_laggards", f"SELECT ticker, {R('price_pct')} AS price_pct FROM (SELECT *, row_number() OVER (ORDER BY price_pct DESC, ticker) AS a, row_number() OVER (ORDER BY price_pct, ticker) AS b FROM perf) WHERE a <= 5 OR b <= 5")
def _(spark, d):
    return core.top_and_bottom(_perf(spark, d).select("ticker", "price_pct"), F.col("price_pct"), 5, "ticker").select("ticker", r6("price_pct", "price_pct"))


@query("f4_latest_rows", f"SELECT ticker, max(date) AS date, {R('last(close ORDER BY date)')} AS close FROM bars GROUP BY 1")
def _(spark, d):
    return pf.latest_rows(sy.bars(spark, d)).select("ticker", "date", r6("close", "close"))


@query("h5_business_days", "SELECT ticker, max(date) AS last_date, CAST(max(date) + CASE dayofweek(max(date)) WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 1 END AS DATE) AS next_day FROM bars GROUP BY 1")
def _(spark, d):
    return sy.bars(spark, d).groupBy("ticker").agg(F.max("date").alias("last_date")).withColumn("next_day", ts.business_day(F.col("last_date"), F.lit(1)))


# ---------------------------------------------------------------- corporate actions


@query("k1_price_jumps", "SELECT ticker, date, ratio, kind, jump FROM jumps")
def _(spark, d):
    return ca.price_jumps(sy.bars(spark, d), sy.splits(spark))


@query("k2_split_adjusted", f"SELECT ticker, date, {Rs('close', 'volume')} FROM adj")
def _(spark, d):
    return ca.adjust_for_splits(_bars(spark, d), sy.splits(spark)).select("ticker", "date", *r6s("close", "volume"))


@query("k3_renamed", f"""SELECT CASE WHEN ticker IN ('Brand#21', 'Brand#22') THEN 'Brand#23' ELSE ticker END AS ticker, ticker AS source_ticker, date, {R('close')} AS close FROM bars
       WHERE NOT (ticker = 'Brand#21' AND date >= DATE '1998-01-02') AND NOT (ticker = 'Brand#22' AND date >= DATE '2000-01-03')""")
def _(spark, d):
    return ca.apply_renames(sy.bars(spark, d), sy.renames(spark)).select("ticker", "source_ticker", "date", r6("close", "close"))


@query("k4_market_cap", f"SELECT ticker, date, {Rs('shares', 'market_cap')} FROM cap")
def _(spark, d):
    return ca.market_cap(sy.bars(spark, d), sy.shares(spark, d), sy.splits(spark)).select("ticker", "date", *r6s("shares", "market_cap"))


@query("k5_total_return", f"SELECT ticker, date, {R('adj_close')} AS adj_close FROM tr")
def _(spark, d):
    return ca.adjusted_close(_bars(spark, d), sy.dividends(spark, d), sy.splits(spark)).select("ticker", "date", r6("adj_close", "adj_close"))


@query("k6_simple_dividends", f"""SELECT b.ticker, b.date, {R('b.close * coalesce(p, 1.0)')} AS adj_close FROM bars b LEFT JOIN (SELECT b.ticker, b.date, product(factor) AS p FROM bars b JOIN
       (SELECT d.ticker, closing_date, 1 - dividend_value / close AS factor FROM dividends d ASOF JOIN bars a ON d.ticker = a.ticker AND d.closing_date > a.date) f ON b.ticker = f.ticker AND b.date < f.closing_date GROUP BY 1, 2) x ON b.ticker = x.ticker AND b.date = x.date""")
def _(spark, d):
    return ca.simple_adjusted_close(sy.bars(spark, d), sy.dividends(spark, d)).select("ticker", "date", r6("adj_close", "adj_close"))


@query("k7_risk_free", f"SELECT month, {R('rf')} AS rf FROM rf")
def _(spark, d):
    return ca.risk_free_monthly(_panel(spark, d).select("month").distinct(), sy.key_rate(spark), "month").select("month", r6("rf", "rf"))


@query("k8_full_history", f"""SELECT ticker, date, source_ticker, {R('close / coalesce((SELECT product(ratio) FROM jumps j WHERE j.ticker = x.ticker AND j.date > x.date AND (kind = $$price$$ OR (kind = $$auto$$ AND jump))), 1.0)')} AS close FROM
       (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY (source_ticker = ticker) DESC, source_ticker DESC) AS rn FROM (SELECT CASE WHEN ticker IN ('Brand#21', 'Brand#22') THEN 'Brand#23' ELSE ticker END AS ticker, ticker AS source_ticker, date, close FROM bars
       WHERE NOT (ticker = 'Brand#21' AND date >= DATE '1998-01-02') AND NOT (ticker = 'Brand#22' AND date >= DATE '2000-01-03'))) x WHERE rn = 1""")
def _(spark, d):
    return ca.full_history(sy.bars(spark, d), sy.renames(spark), sy.splits(spark)).select("ticker", "date", "source_ticker", r6("close", "close"))


# ---------------------------------------------------------------- market overview


def _bars(spark, d):
    """Bars that a query reads more than once: derived from the lines once, held by the executors in memory or on disk, derived again where
    one is lost."""
    return sy.bars(spark, d).persist()


def _capped(spark, d):
    return ca.market_cap(_bars(spark, d), sy.shares(spark, d), sy.splits(spark))


def _perf(spark, d):
    return pf.period_performance(_capped(spark, d), PERIOD)


def _enriched(spark, d):
    return pf.enrich(_perf(spark, d), pf.risk_table(sy.bars(spark, d), sy.index_bars(spark, d)), pf.index_return(sy.index_bars(spark, d), PERIOD))


@query("k9_period_performance", f"SELECT ticker, first_date, last_date, {Rs('first_price', 'last_price', 'price_pct', 'cap_pct', 'cap_change')} FROM perf")
def k9(spark, d):
    return _perf(spark, d).select("ticker", "first_date", "last_date", *r6s("first_price", "last_price", "price_pct", "cap_pct", "cap_change"))


@query("k10_performance_as_of", f"""SELECT ticker, first_date, last_date, {R('(l / f - 1) * 100')} AS price_pct FROM (SELECT ticker, count(*) AS n, min(date) AS first_date, max(date) AS last_date, first(close ORDER BY date) AS f, last(close ORDER BY date) AS l
       FROM bars WHERE date BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' GROUP BY 1) WHERE n >= 2 AND f > 0""")
def _(spark, d):
    return pf.period_performance(sy.bars(spark, d), start="1999-01-01", end="1999-12-31").select("ticker", "first_date", "last_date", r6("price_pct", "price_pct"))


@query("k11_risk_table", f"SELECT ticker, n, {Rs('vol', 'max_drawdown', 'from_high', 'beta')} FROM risk")
def _(spark, d):
    return pf.risk_table(sy.bars(spark, d), sy.index_bars(spark, d)).select("ticker", "n", *r6s("vol", "max_drawdown", "from_high", "beta"))


@query("k12_sigma_alpha", f"SELECT ticker, {Rs('price_pct', 'sigma_move', 'alpha')} FROM enriched")
def _(spark, d):
    return _enriched(spark, d).select("ticker", *r6s("price_pct", "sigma_move", "alpha"))


@query("k13_filtered", f"SELECT ticker, {Rs('last_cap', 'price_pct')} FROM perf WHERE last_cap IS NULL OR last_cap >= 2e7")
def _(spark, d):
    return pf.filter_and_sort(_perf(spark, d), 2e7).select("ticker", *r6s("last_cap", "price_pct"))


@query("k14_display", "SELECT ticker, strftime(first_date, '%d.%m.%Y') AS first_date, strftime(last_date, '%d.%m.%Y') AS last_date, last_cap IS NULL AS no_cap FROM perf")
def _(spark, d):
    return pf.performance_display(_perf(spark, d)).select("ticker", "first_date", "last_date", F.col("cap_bn").isNull().alias("no_cap"))


@query("k15_summary", f"""SELECT CAST(count(*) AS BIGINT) AS n, CAST(count_if(price_pct > 0) AS BIGINT) AS n_up, CAST(count_if(price_pct < 0) AS BIGINT) AS n_down, {R('median(price_pct)')} AS median_pct,
       {R('sum(CASE WHEN first_cap IS NOT NULL AND last_cap IS NOT NULL THEN last_cap END) / sum(CASE WHEN first_cap IS NOT NULL AND last_cap IS NOT NULL THEN first_cap END) * 100 - 100')} AS weighted_pct,
       string_agg(ticker, ', ' ORDER BY a) FILTER (a <= 5) AS best, string_agg(ticker, ', ' ORDER BY b) FILTER (b <= 5) AS worst FROM (SELECT *, row_number() OVER (ORDER BY price_pct DESC, ticker) AS a, row_number() OVER (ORDER BY price_pct, ticker) AS b FROM perf)""")
def _(spark, d):
    return pf.market_summary(_perf(spark, d)).select(*big("n", "n_up", "n_down"), *r6s("median_pct", "weighted_pct"), "best", "worst")


@query("k16_marimekko", f"SELECT ticker, {R('100 * last_cap / sum(last_cap) OVER ()')} AS share FROM perf WHERE last_cap IS NOT NULL AND price_pct IS NOT NULL")
def _(spark, d):
    return pf.marimekko(_perf(spark, d)).select("ticker", r6("share", "share"))


@query("k17_index_trend", f"SELECT {R('(SELECT index_pct FROM ipct)')} AS index_pct, " + ", ".join(f"{R(f'list_reduce(list(close ORDER BY date), lambda acc, x: acc * (1 - 2.0 / {s + 1}) + x * (2.0 / {s + 1}))')} AS {n}" for s, n in ((16, "fast"), (64, "slow"))) + " FROM idx")
def _(spark, d):
    return pf.index_return(sy.index_bars(spark, d), PERIOD).select(*r6s("index_pct", "fast", "slow"))


@query("k18_breadth", "SELECT date, " + ", ".join(f"{R(f'100 * avg(CASE WHEN px IS NOT NULL AND m{n} IS NOT NULL THEN CAST(px > m{n} AS INT) END)')} AS above_ma{n}" for n in (50, 200)) + """ FROM (SELECT date, px, CASE WHEN count(px) OVER a >= 50 THEN avg(px) OVER a END AS m50, CASE WHEN count(px) OVER b >= 200 THEN avg(px) OVER b END AS m200
       FROM dense WINDOW a AS (PARTITION BY ticker ORDER BY date ROWS 49 PRECEDING), b AS (PARTITION BY ticker ORDER BY date ROWS 199 PRECEDING)) GROUP BY 1""")
def _(spark, d):
    return pf.breadth(sy.bars(spark, d)).select("date", *r6s("above_ma50", "above_ma200"))


@query("k18_near_extremes", """SELECT CAST(count_if(l >= 0.98 * h) AS BIGINT) AS n_near_high, CAST(count_if(l <= 1.02 * w) AS BIGINT) AS n_near_low FROM (SELECT ticker, max(close) AS h, min(close) AS w, last(close ORDER BY date) AS l FROM bars
       WHERE date >= (SELECT CAST(max(date) - INTERVAL 1 YEAR AS DATE) FROM bars) GROUP BY 1)""")
def _(spark, d):
    return pf.breadth_now(sy.bars(spark, d)).select(*big("n_near_high", "n_near_low"))


@query("k19_sectors", f"""SELECT sector, CAST(count(*) AS BIGINT) AS n, {R('coalesce(sum(CASE WHEN first_cap IS NOT NULL AND last_cap IS NOT NULL THEN last_cap END) / nullif(sum(CASE WHEN first_cap IS NOT NULL AND last_cap IS NOT NULL THEN first_cap END), 0) * 100 - 100, median(price_pct))')} AS pct,
       array_to_string(list(ticker ORDER BY ticker)[1:5], ', ') AS members FROM (SELECT p.*, coalesce(sector, 'other') AS sector FROM perf p LEFT JOIN sectors s ON p.ticker = s.ticker) GROUP BY 1""")
def _(spark, d):
    return pf.sector_performance(_perf(spark, d), sy.sectors(spark, d)).select("sector", "n", r6("pct", "pct"), "members")


@query("k20_market_map", f"""SELECT sector, ticker, {R('sum(last_cap)')} AS cap, {R('sum(price_pct * last_cap) / sum(last_cap)')} AS pct FROM (SELECT p.ticker, price_pct, last_cap, coalesce(sector, 'other') AS sector FROM perf p LEFT JOIN sectors s ON p.ticker = s.ticker WHERE last_cap > 0) GROUP BY ROLLUP (sector, ticker)""")
def _(spark, d):
    return pf.market_map(_perf(spark, d), sy.sectors(spark, d)).select("sector", "ticker", *r6s("cap", "pct"))


@query("k21_unusual_turnover", f"""SELECT ticker, {R('now / base')} AS times FROM (SELECT b.ticker, avg(CASE WHEN date >= s THEN value_rub END) AS now, avg(CASE WHEN date < s THEN value_rub END) AS base FROM bars b, (SELECT CAST(max(date) - INTERVAL 1 MONTH AS DATE) AS s FROM bars) WHERE date >= s - 90 GROUP BY 1) JOIN perf USING (ticker)
       WHERE base > 1000 AND now IS NOT NULL ORDER BY now / base DESC, ticker LIMIT 10""")
def _(spark, d):
    return pf.unusual_turnover(sy.bars(spark, d), _perf(spark, d), "1m", least_base=1000).select("ticker", r6("times", "times"))


@query("k22_unusual_moves", f"SELECT ticker, {R('sigma_move')} AS sigma_move FROM enriched WHERE abs(sigma_move) >= 0.02 ORDER BY abs(sigma_move) DESC, ticker LIMIT 10")
def _(spark, d):
    return pf.unusual_moves(_enriched(spark, d), 0.02).select("ticker", r6("sigma_move", "sigma_move"))


@query("k23_structure", f"""SELECT CAST(count(*) AS BIGINT) AS n, CAST(count_if(pct > 0) AS BIGINT) AS n_up, CAST(count_if(pct < 0) AS BIGINT) AS n_down, {R('median(pct)')} AS median_pct,
       {R('100 * sum(CASE WHEN a <= 5 THEN then_cap END) / sum(then_cap)')} AS top5_then, {R('100 * sum(CASE WHEN b <= 5 THEN now_cap END) / sum(now_cap)')} AS top5_now
       FROM (SELECT *, row_number() OVER (ORDER BY then_cap DESC NULLS LAST, ticker) AS a, row_number() OVER (ORDER BY now_cap DESC NULLS LAST, ticker) AS b FROM then_now) HAVING count(*) >= 5""")
def _(spark, d):
    return pf.structure_vs_anchor(_capped(spark, d), ANCHOR).select(*big("n", "n_up", "n_down"), *r6s("median_pct", "top5_then", "top5_now"))


@query("k24_contributions", f"SELECT ticker, {R('c')} AS contribution FROM (SELECT ticker, 100 * (now_cap - then_cap) / sum(then_cap) OVER () AS c FROM then_now WHERE then_cap IS NOT NULL AND now_cap IS NOT NULL) ORDER BY abs(c) DESC, ticker LIMIT 12")
def _(spark, d):
    return pf.contributions(pf.comparable(_capped(spark, d), ANCHOR)).select("ticker", r6("contribution", "contribution"))


@query("k25_sector_weights", f"SELECT sector, {R('100 * t / sum(t) OVER ()')} AS then_share, {R('100 * w / sum(w) OVER ()')} AS now_share FROM (SELECT coalesce(sector, 'other') AS sector, sum(then_cap) AS t, sum(now_cap) AS w FROM then_now c LEFT JOIN sectors s ON c.ticker = s.ticker GROUP BY 1)")
def _(spark, d):
    return pf.sector_weights(pf.comparable(_capped(spark, d), ANCHOR), sy.sectors(spark, d)).select("sector", *r6s("then_share", "now_share"))


# ---------------------------------------------------------------- security metrics


def _total(spark, d):
    return ca.adjusted_close(_bars(spark, d), sy.dividends(spark, d), sy.splits(spark))


@query("k26_security_metrics", f"""SELECT ticker, {R('(p1 / p0 - 1) * 100')} AS price_return, {R('(t1 / t0 - 1) * 100')} AS total_return, {R('sd * sqrt(252.0) * 100')} AS vol, {R('q * 100')} AS var5, {R('sk')} AS skew, {R('ku')} AS kurt, {R('mdd * 100')} AS max_drawdown,
       {R('CASE WHEN nc > 30 THEN cv / vi END')} AS beta, {R('CASE WHEN nc > 30 THEN co END')} AS corr FROM (SELECT ticker, first(raw ORDER BY date) AS p0, last(raw ORDER BY date) AS p1, first(adj_close ORDER BY date) AS t0, last(adj_close ORDER BY date) AS t1, stddev_samp(ret) AS sd,
       quantile_cont(ret, 0.05) AS q, skewness(ret) AS sk, kurtosis(ret) AS ku, min(dd) AS mdd, count(CASE WHEN ret IS NOT NULL THEN idx END) AS nc, covar_samp(ret, idx) AS cv, var_samp(CASE WHEN ret IS NOT NULL THEN idx END) AS vi, corr(ret, idx) AS co
       FROM (SELECT t.*, i.idx, adj_close / lag(adj_close) OVER w - 1 AS ret, adj_close / max(adj_close) OVER w - 1 AS dd FROM tr t LEFT JOIN iret i ON t.date = i.date WINDOW w AS (PARTITION BY ticker ORDER BY t.date)) GROUP BY 1)""")
def _(spark, d):
    return rk.security_metrics(_total(spark, d), sy.index_bars(spark, d)).select("ticker", *r6s("price_return", "total_return", "vol", "var5", "skew", "kurt", "max_drawdown", "beta", "corr"))


@query("b9_sign_flags", "SELECT ticker, CAST(CASE WHEN ret > 0.01 THEN 1 WHEN ret < -0.01 THEN -1 ELSE 0 END AS BIGINT) AS flag, CAST(count(*) AS BIGINT) AS n FROM lret GROUP BY 1, 2")
def _(spark, d):
    return _lret(spark, d).groupBy("ticker", pf.sign_flags(F.col("ret"), 0.01).cast("long").alias("flag")).agg(F.count("*").alias("n"))


@query("b11_price_column", f"SELECT ticker, {R('avg(adj_close)')} AS mean_price FROM tr GROUP BY 1")
def _(spark, d):
    rows = _total(spark, d)
    return rows.groupBy("ticker").agg(r6(F.avg(mk.price_column(rows, "adj_close", "close")), "mean_price"))


@query("k27_benchmark", f"SELECT w, date, {R('close')} AS close FROM (SELECT 12 AS w, date, close FROM idx UNION ALL SELECT 2, date, close FROM idx WHERE date >= (SELECT max(date) - 5 FROM idx))")
def _(spark, d):
    price = sy.index_bars(spark, d)
    last = price.agg(F.date_sub(F.max("date"), 5).alias("since"))
    total = durable(price.join(F.broadcast(last), F.col("date") >= F.col("since")).select("date", "close"), "total-return-index")  # a few days: enough for 2 rows, not for 12
    picked = [rk.choose_benchmark(total, price, least).select(F.lit(least).alias("w"), "date", r6("close", "close")) for least in (12, 2)]
    return picked[0].unionByName(picked[1])


@query("k28_relative_strength", f"SELECT ticker, date, {R('100 * q / first_value(q) OVER (PARTITION BY ticker ORDER BY date)')} AS rs FROM (SELECT b.ticker, b.date, b.close / i.close AS q FROM bars b JOIN idx i ON b.date = i.date)")
def _(spark, d):
    return rk.relative_strength(sy.bars(spark, d), sy.index_bars(spark, d)).select("ticker", "date", r6("rs", "rs"))


@query("k28_rebased", f"SELECT ticker, date, {R('100 * close / first_value(close) OVER (PARTITION BY ticker ORDER BY date)')} AS rebased FROM bars")
def _(spark, d):
    return rk.rebased(sy.bars(spark, d)).select("ticker", "date", r6("rebased", "rebased"))


@query("k29_rolling_beta", f"""SELECT ticker, date, {R('CASE WHEN count(r) OVER w >= 126 THEN covar_samp(r, m) OVER w / var_samp(m) OVER w END')} AS beta, {R('CASE WHEN count(r) OVER w >= 126 THEN corr(r, m) OVER w END')} AS corr
       FROM (SELECT b.ticker, b.date, b.close / lag(b.close) OVER p - 1 AS r, i.close / lag(i.close) OVER p - 1 AS m FROM bars b JOIN idx i ON b.date = i.date WINDOW p AS (PARTITION BY b.ticker ORDER BY b.date)) WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS 125 PRECEDING)""")
def _(spark, d):
    return rk.rolling_beta_corr(sy.bars(spark, d), sy.index_bars(spark, d)).select("ticker", "date", *r6s("beta", "corr"))


@query("k29_rolling_vol", "SELECT ticker, date, " + ", ".join(f"{R(f'CASE WHEN count(ret) OVER w{n} >= {n} THEN stddev_samp(ret) OVER w{n} * sqrt(252.0) * 100 END')} AS vol_{n}" for n in (30, 90, 252)) + " FROM (SELECT ticker, date, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret FROM bars) WINDOW " + ", ".join(f"w{n} AS (PARTITION BY ticker ORDER BY date ROWS {n - 1} PRECEDING)" for n in (30, 90, 252)))
def _(spark, d):
    return rk.rolling_vol(sy.bars(spark, d)).select("ticker", "date", *r6s("vol_30", "vol_90", "vol_252"))


@query("k29_turnover_mean", f"SELECT ticker, date, {R('CASE WHEN count(value_rub) OVER w >= 20 THEN avg(value_rub) OVER w END')} AS turnover_ma20 FROM bars WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS 19 PRECEDING)")
def _(spark, d):
    return rk.turnover_mean(sy.bars(spark, d)).select("ticker", "date", r6("turnover_ma20", "turnover_ma20"))


@query("k30_worst_drawdown", f"SELECT ticker, {R('100 * min(dd)')} AS drawdown, arg_min(date, (dd, date)) AS date FROM (SELECT ticker, date, close / max(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS dd FROM bars) GROUP BY 1")
def _(spark, d):
    return rk.worst_drawdown(sy.bars(spark, d)).select("ticker", r6("drawdown", "drawdown"), "date")


@query("k31_qq_points", f"""SELECT ticker, {Rs('sample', 'p')}, {R('CASE WHEN p < 0.5 THEN -z ELSE z END')} AS theory FROM (SELECT *, t - (2.515517 + 0.802853 * t + 0.010328 * t * t) / (1 + 1.432788 * t + 0.189269 * t * t + 0.001308 * t * t * t) AS z FROM (SELECT *, sqrt(-2 * ln(least(p, 1 - p))) AS t FROM
       (SELECT ticker, ret AS sample, (row_number() OVER (PARTITION BY ticker ORDER BY ret) - 0.5::DOUBLE) / count(*) OVER (PARTITION BY ticker) AS p FROM lret)))""")
def _(spark, d):
    return rk.qq_points(ts.log_returns(sy.bars(spark, d)), "ret").select("ticker", *r6s("sample", "p", "theory"))


@query("k50_return_stats", f"SELECT ticker, CAST(count(ret) AS BIGINT) AS n, {R('exp(sum(ret) / (count(ret) / 252.0)) - 1')} AS cagr, {R('stddev_samp(ret) * sqrt(252.0)')} AS vol FROM vret GROUP BY 1 HAVING count(ret) > 1")
def _(spark, d):
    return rk.return_stats(sy.bars(spark, d)).select("ticker", "n", *r6s("cagr", "vol"))


@query("k50_stats_summary", f"SELECT CAST(count(*) AS BIGINT) AS n, {R('avg(c)')} AS mean_cagr, {R('median(c)')} AS median_cagr, {R('avg(v)')} AS mean_vol, arg_max(ticker, (c, ticker)) AS best_cagr, arg_min(ticker, (c, ticker)) AS worst_cagr FROM (SELECT ticker, exp(sum(ret) / (count(ret) / 252.0)) - 1 AS c, stddev_samp(ret) * sqrt(252.0) AS v FROM vret GROUP BY 1 HAVING count(ret) > 1)")
def _(spark, d):
    return rk.stats_summary(rk.return_stats(sy.bars(spark, d))).select("n", *r6s("mean_cagr", "median_cagr", "mean_vol"), "best_cagr", "worst_cagr")


@query("k51_calendar_cagr", f"SELECT ticker, {R('y')} AS years, {R('pow(p1 / p0, 1 / y) - 1')} AS price_cagr, {R('pow(t1 / t0, 1 / y) - 1')} AS total_cagr FROM (SELECT ticker, date_diff('day', min(date), max(date)) / 365.25 AS y, first(raw ORDER BY date) AS p0, last(raw ORDER BY date) AS p1, first(adj_close ORDER BY date) AS t0, last(adj_close ORDER BY date) AS t1 FROM tr WHERE date >= DATE '1996-01-01' GROUP BY 1)")
def _(spark, d):
    return rk.cagr_by_calendar(_total(spark, d), "1996-01-01").select("ticker", *r6s("years", "price_cagr", "total_cagr"))


@query("k52_growth_of_both", f"""SELECT p.ticker, {R('pc')} AS price_cagr, {R('tc')} AS total_cagr, {R('tc - pc')} AS dividend_yield, {R('pv')} AS price_vol, {R('tv')} AS total_vol FROM (SELECT ticker, exp(sum(ret) / (count(ret) / 252.0)) - 1 AS pc, stddev_samp(ret) * sqrt(252.0) AS pv FROM vret GROUP BY 1 HAVING count(ret) > 1) p
       JOIN (SELECT ticker, exp(sum(ret) / (count(ret) / 252.0)) - 1 AS tc, stddev_samp(ret) * sqrt(252.0) AS tv FROM (SELECT t.ticker, ln(adj_close / lag(adj_close) OVER (PARTITION BY t.ticker ORDER BY date)) AS ret FROM tr t JOIN (SELECT ticker, median(adj_close) AS mid FROM tr WHERE adj_close > 0 GROUP BY 1) m ON m.ticker = t.ticker WHERE adj_close > 0 AND adj_close BETWEEN 0.01 * mid AND 1000 * mid) GROUP BY 1 HAVING count(ret) > 1) t ON t.ticker = p.ticker""")
def _(spark, d):
    return rk.growth_of_both(durable(_total(spark, d), "total-return")).select("ticker", *r6s("price_cagr", "total_cagr", "dividend_yield", "price_vol", "total_vol"))


@query("k53_index_yearly", f"SELECT {R('avg(r) * 250')} AS mean, {R('stddev_samp(r) * sqrt(250.0)')} AS sd FROM (SELECT ln(close / lag(close) OVER (ORDER BY date)) AS r FROM idx)")
def _(spark, d):
    return rk.index_yearly(sy.index_bars(spark, d)).select(*r6s("mean", "sd"))


# ---------------------------------------------------------------- backtest


def _panel(spark, d):
    """A row for each ticker and month, read many times: written once."""
    return durable(bt.monthly_panel(durable(_total(spark, d), "total-return"), total="adj_close"), "panel")


def _months(panel):
    return panel.select("month", "ord").distinct()


@query("k32_monthly_panel", f"SELECT ticker, month, CAST(ord AS BIGINT) AS ord, {Rs('px', 'turnover', 'ret', 'vol', 'div')} FROM panel")
def _(spark, d):
    return _panel(spark, d).select("ticker", "month", *big("ord"), *r6s("px", "turnover", "ret", "vol", "div"))


@query("k33_benchmark", f"SELECT month, {R('bench')} AS bench, ewmac, above_ma FROM bench LEFT JOIN trend USING (month)")
def _(spark, d):
    return bt.benchmark_monthly(sy.index_bars(spark, d)).select("month", r6("bench", "bench"), "ewmac", "above_ma")


@query("k34_momentum", f"SELECT ticker, month, {R('mom')} AS mom FROM sig")
def _(spark, d):
    return bt.momentum_signal(_panel(spark, d), 6, 1).select("ticker", "month", r6("mom", "mom"))


def _pct(x: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN (rank() OVER (PARTITION BY month ORDER BY {x} NULLS LAST) + (count({x}) OVER (PARTITION BY month, {x}) - 1) / 2.0) / count({x}) OVER (PARTITION BY month) END"


@query("k35_composite", f"""SELECT ticker, month, {R('CASE WHEN mom IS NOT NULL THEN (coalesce(a * 1.0, 0.0) + coalesce(b * 0.5, 0.0) + coalesce(c * 0.5, 0.0)) / (CASE WHEN a IS NOT NULL THEN 1.0 ELSE 0 END + CASE WHEN b IS NOT NULL THEN 0.5 ELSE 0 END + CASE WHEN c IS NOT NULL THEN 0.5 ELSE 0 END) END')} AS score
       FROM (SELECT ticker, month, mom, {_pct('mom')} AS a, {_pct('nvol')} AS b, {_pct('div')} AS c FROM (SELECT * REPLACE ({R('div')} AS div), -vol AS nvol FROM sig))""")
def _(spark, d):
    panel = _panel(spark, d).withColumn("div", r6("div"))  # months without dividends differ from 0 by rounding alone
    return bt.composite_signal(bt.momentum_signal(panel, 6, 1)).select("ticker", "month", r6("score", "score"))


@query("k36_weights", f"SELECT ticker, month, {R('weight')} AS weight FROM wreb")
def _(spark, d):
    return bt.rebalance_weights(bt.momentum_signal(_panel(spark, d), 6, 1), top_n=15).select("ticker", "month", r6("weight", "weight"))


@query("k36_weights_long_short", f"""SELECT ticker, month, {R('CASE WHEN down <= k THEN CASE WHEN si > 0 THEN -coalesce(i_s, 0.0) / si ELSE -1.0 / k END ELSE CASE WHEN li > 0 THEN coalesce(i_l, 0.0) / li ELSE 1.0 / k END END')} AS weight FROM (SELECT *, sum(i_l) OVER (PARTITION BY month) AS li, sum(i_s) OVER (PARTITION BY month) AS si
       FROM (SELECT *, CASE WHEN up <= k AND vol > 0 THEN 1 / vol END AS i_l, CASE WHEN down <= k AND vol > 0 THEN 1 / vol END AS i_s FROM ranked)) WHERE up <= k OR down <= k""")
def _(spark, d):
    return bt.rebalance_weights(bt.momentum_signal(_panel(spark, d), 6, 1), long_short=True, top_n=15, weighting="inverse_vol").select("ticker", "month", r6("weight", "weight"))


@query("k37_holding", f"SELECT ticker, month, {R('weight')} AS weight FROM whold")
def _(spark, d):
    p = _panel(spark, d)
    return bt.apply_holding(bt.rebalance_weights(bt.momentum_signal(p, 6, 1), top_n=15), 3, _months(p)).select("ticker", "month", r6("weight", "weight"))


@query("k38_backtest", f"SELECT month, {Rs('ret_gross', 'turnover', 'tc', 'ret_net')} FROM bt")
def _(spark, d):
    return bt.run_strategy(_panel(spark, d)).select("month", *r6s("ret_gross", "turnover", "tc", "ret_net"))


@query("k40_gated_and_scaled", f"""SELECT month, {R('coalesce(g, 0)')} AS ret_gross, {R('coalesce(t, 0)')} AS turnover, {R('coalesce(g, 0) - coalesce(t, 0) * 10 / 1e4')} AS ret_net FROM mcal c LEFT JOIN (SELECT w.ord + 1 AS ord, sum(weight * CASE WHEN ret IS NULL OR ret <= -1 THEN -1 ELSE ret END) AS g FROM wscaled w LEFT JOIN panel p ON p.ticker = w.ticker AND p.ord = w.ord + 1 GROUP BY 1) x ON x.ord = c.ord
       LEFT JOIN (SELECT ord, sum(abs(d)) / 2 AS t FROM (SELECT ticker, ord, sum(w) AS d FROM (SELECT ticker, ord, weight AS w FROM wscaled UNION ALL SELECT ticker, ord + 1, -weight FROM wscaled) GROUP BY 1, 2) GROUP BY 1) y ON y.ord = c.ord WHERE c.ord > 8""")
def _(spark, d):
    trend = bt.benchmark_monthly(sy.index_bars(spark, d))
    return bt.run_strategy(_panel(spark, d), trend=trend, target=0.15, missing="penalize").select("month", *r6s("ret_gross", "turnover", "ret_net"))


@query("k42_perf_stats", f"""SELECT {R('pow(product(1 + ret_net), 12.0 / count(*)) - 1')} AS cagr, {R('stddev_pop(ret_net) * sqrt(12.0)')} AS vol, {R('avg(ret_net - coalesce(rf, 0)) / stddev_pop(ret_net - coalesce(rf, 0)) * sqrt(12.0)')} AS sharpe, CAST(count(*) AS BIGINT) AS n_months,
       {R('stddev_pop(ret_net - bench) * sqrt(12.0)')} AS te, {R('avg(ret_net - bench) / stddev_pop(ret_net - bench) * sqrt(12.0)')} AS ir FROM bt LEFT JOIN bench USING (month) LEFT JOIN rf USING (month)""")
def _(spark, d):
    panel = _panel(spark, d)
    rf = ca.risk_free_monthly(panel.select("month").distinct(), sy.key_rate(spark), "month")
    return bt.perf_stats(bt.run_strategy(panel), bt.benchmark_monthly(sy.index_bars(spark, d)), rf).select(*r6s("cagr", "vol", "sharpe"), "n_months", *r6s("te", "ir"))


@query("k44_equity", f"SELECT month, {R('ln(equity)')} AS log_equity, {R('equity / max(equity) OVER (ORDER BY month) - 1')} AS drawdown FROM (SELECT month, product(1 + ret_net) OVER (ORDER BY month) AS equity FROM bt)")
def _(spark, d):
    return bt.equity_curve(bt.run_strategy(_panel(spark, d))).select("month", r6(F.ln("equity"), "log_equity"), r6("drawdown", "drawdown"))


@query("k45_calendar_table", "SELECT CAST(year(month) AS BIGINT) AS year, " + ", ".join(f"{R(f'max(CASE WHEN month(month) = {m} THEN ret_net END)')} AS m{m:02d}" for m in range(1, 13)) + f", {R('product(1 + ret_net) - 1')} AS total FROM bt GROUP BY 1")
def _(spark, d):
    return bt.calendar_table(bt.run_strategy(_panel(spark, d))).select(*big("year"), *r6s(*[f"m{m:02d}" for m in range(1, 13)], "total"))


@query("k46_composition", f"""SELECT w.ticker, {R('w.weight')} AS weight, {R('s.mom')} AS mom, coalesce(x.sector, 'other') AS sector, {R('n.ret')} AS next_ret FROM whold w LEFT JOIN sig s ON s.ticker = w.ticker AND s.month = w.month LEFT JOIN sectors x ON x.ticker = w.ticker LEFT JOIN panel n ON n.ticker = w.ticker AND n.ord = w.ord + 1 WHERE w.month = DATE '1999-06-30'""")
def _(spark, d):
    panel = bt.momentum_signal(_panel(spark, d), 6, 1)
    held = bt.apply_holding(bt.rebalance_weights(panel, top_n=15), 3, _months(panel))
    return bt.composition(held, panel, sy.sectors(spark, d), "1999-06-30").select("ticker", *r6s("weight", "mom"), "sector", r6("next_ret", "next_ret"))


def _grid(spark, d):
    panel = _panel(spark, d)
    rf = ca.risk_free_monthly(panel.select("month").distinct(), sy.key_rate(spark), "month")
    return bt.grid_parts(panel, bt.benchmark_monthly(sy.index_bars(spark, d)), bt.parameter_grid(spark), rf=rf)


def _walked(spark, d):
    return bt.walk_forward(_grid(spark, d), bt.parameter_grid(spark))


@query("k47_walk_forward", f"SELECT CAST(config AS INT) AS config, lookback, skip, hold, q, long_short, {Rs('train_sharpe', 'test_sharpe', 'train_cagr', 'test_cagr')}, chosen FROM walked")
def _(spark, d):
    return _walked(spark, d).select("config", "lookback", "skip", "hold", "q", "long_short", *r6s("train_sharpe", "test_sharpe", "train_cagr", "test_cagr"), "chosen")


@query("k48_robustness", "SELECT lookback, " + ", ".join(f"{R(f'avg(CASE WHEN hold = {h} THEN test_sharpe END)')} AS hold_{h}" for h in (1, 3, 6)) + " FROM walked GROUP BY 1")
def _(spark, d):
    table = bt.robustness(_walked(spark, d))
    return table.select("lookback", *[r6(F.col(str(h)), f"hold_{h}") for h in (1, 3, 6)])


@query("k49_out_of_sample", f"SELECT month, {R('product(1 + ret_net) OVER w')} AS equity, {R('product(1 + bench) OVER w')} AS bench_equity FROM gparts WHERE part = 'test' AND config = (SELECT config FROM walked WHERE chosen) WINDOW w AS (ORDER BY month ROWS UNBOUNDED PRECEDING)")
def _(spark, d):
    parts = _grid(spark, d)
    return bt.out_of_sample(parts, bt.walk_forward(parts, bt.parameter_grid(spark))).select("month", *r6s("equity", "bench_equity"))


@query("k73_panel_status", "SELECT CAST(count(DISTINCT ticker) AS BIGINT) AS tickers, CAST(count(DISTINCT month) AS BIGINT) AS months, min(month) AS first_month, max(month) AS last_month, CAST(count_if(ret <= -1) AS BIGINT) AS wiped_out FROM panel")
def _(spark, d):
    return bt.panel_status(_panel(spark, d))


@query("k74_span", f"SELECT min(date) AS first_date, max(date) AS last_date, {R('date_diff($$day$$, min(date), max(date)) / 365.25')} AS years, CAST(count(DISTINCT ticker) AS BIGINT) AS tickers FROM bars")
def _(spark, d):
    out = sy.bars(spark, d).agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count_distinct("ticker").alias("tickers"))
    return out.withColumn("years", r6(F.datediff("last_date", "first_date") / 365.25))


# ---------------------------------------------------------------- portfolio, bonds


def _complete(spark, d):
    """Closes at the ends of months in which every security with a full history has one."""
    own = rk.complete_tickers(sy.bars(spark, d), "1995-01-01")
    closes = own.groupBy("ticker", F.last_day("date").alias("date")).agg(F.max_by("close", "date").alias("close"))
    return po.complete_case(durable(closes, "month-ends"))


@query("k54_complete_case", f"SELECT ticker, date, {R('close')} AS px FROM cc")
def _(spark, d):
    return _complete(spark, d).select("ticker", "date", r6("px", "px"))


@query("k55_correlations", f"SELECT x.ticker AS a, y.ticker AS b, {R('corr(x.ret, y.ret)')} AS corr, CAST(count(*) AS BIGINT) AS n FROM dret x JOIN dret y ON x.date = y.date AND x.ticker <= y.ticker WHERE x.ret IS NOT NULL AND y.ret IS NOT NULL GROUP BY 1, 2")
def _(spark, d):
    rets = pf.with_returns(pf.dense_closes(sy.bars(spark, d))).where("ret is not null").select("ticker", "date", "ret")
    return po.correlations(rets).select("a", "b", r6("corr", "corr"), "n")


@query("k56_expected_and_covariance", f"SELECT x.ticker AS a, y.ticker AS b, {R('covar_samp(x.ret, y.ret) * 12')} AS cov, {R('any_value(mu)')} AS mu FROM cr x JOIN cr y ON x.date = y.date AND x.ticker <= y.ticker JOIN (SELECT ticker, pow(product(1 + ret), 12.0 / count(*)) - 1 AS mu FROM cr GROUP BY 1) m ON m.ticker = x.ticker GROUP BY 1, 2")
def _(spark, d):
    rets = po.panel_returns(_complete(spark, d))
    cov, mu = po.covariances(rets, MONTHS), po.expected_returns(rets, MONTHS)
    return cov.join(mu, F.col("a") == F.col("ticker")).select("a", "b", *r6s("cov", "mu"))


@query("k57_ledoit_wolf", f"""SELECT a, b, {R('((1 - s) * c + CASE WHEN a = b THEN s * m ELSE 0 END) * 12')} AS cov, {R('s')} AS shrinkage FROM (SELECT a, b, c, m, coalesce(least(err / n, d2) / nullif(d2, 0), 0.0) AS s FROM (SELECT *, ss - p * m * m AS d2 FROM (SELECT *, trace / p AS m FROM
       (SELECT *, count(CASE WHEN a = b THEN 1 END) OVER () AS p, sum(CASE WHEN a = b THEN c END) OVER () AS trace, sum(CASE WHEN a = b THEN 1 ELSE 2 END * c * c) OVER () AS ss, sum(CASE WHEN a = b THEN 1 ELSE 2 END * (q - c * c)) OVER () AS err FROM
       (SELECT x.ticker AS a, y.ticker AS b, avg(x.e * y.e) AS c, avg(pow(x.e * y.e, 2)) AS q, count(*) AS n FROM (SELECT *, ret - avg(ret) OVER (PARTITION BY ticker) AS e FROM cr) x JOIN (SELECT *, ret - avg(ret) OVER (PARTITION BY ticker) AS e FROM cr) y ON x.date = y.date AND x.ticker <= y.ticker GROUP BY 1, 2)))))""")
def _(spark, d):
    return po.ledoit_wolf(po.panel_returns(_complete(spark, d)), MONTHS).select("a", "b", *r6s("cov", "shrinkage"))


@query("k58_frontier_scan", f"""WITH RECURSIVE m AS MATERIALIZED (SELECT ticker, pow(product(1 + ret), 252.0 / count(*)) - 1 AS mu FROM dret WHERE ret IS NOT NULL GROUP BY 1),
       v AS MATERIALIZED (SELECT x.ticker AS a, y.ticker AS b, covar_samp(x.ret, y.ret) * 252 AS cov FROM dret x JOIN dret y ON x.date = y.date AND x.ticker <= y.ticker WHERE x.ret IS NOT NULL AND y.ret IS NOT NULL GROUP BY 1, 2),
       e AS (SELECT portfolio, ticker, pow(-ln((CAST('0x' || substr(md5('11:' || portfolio || ':' || ticker), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE), 2) AS e FROM m, (SELECT unnest(generate_series(0, 1999)) AS portfolio)),
       w AS (SELECT *, greatest(0.3::DOUBLE - w, 0) AS room, sum(greatest(w - 0.3::DOUBLE, 0)) OVER (PARTITION BY portfolio) AS over FROM (SELECT *, e / sum(e) OVER (PARTITION BY portfolio) AS w FROM e)),
       h AS MATERIALIZED (SELECT portfolio, ticker, least(w, 0.3::DOUBLE) + coalesce(over * room / nullif(sum(room) OVER (PARTITION BY portfolio), 0), 0) AS w FROM w),
       s AS MATERIALIZED (SELECT r.portfolio, ret, sqrt(greatest(var, 0)) AS vol, ret / nullif(sqrt(greatest(var, 0)), 0) AS sharpe FROM (SELECT portfolio, sum(w * mu) AS ret FROM h JOIN m USING (ticker) GROUP BY 1) r
         JOIN (SELECT x.portfolio, sum(CASE WHEN a = b THEN 1 ELSE 2 END * x.w * y.w * cov) AS var FROM h x JOIN v ON v.a = x.ticker JOIN h y ON y.portfolio = x.portfolio AND y.ticker = v.b GROUP BY 1) z ON z.portfolio = r.portfolio),
       k AS (SELECT 'bucket-' || CAST(least(floor((ret - lo) / nullif(hi - lo, 0) * 20), 19) AS INT) AS kind, s.*, row_number() OVER (PARTITION BY least(floor((ret - lo) / nullif(hi - lo, 0) * 20), 19) ORDER BY vol, portfolio) AS rn FROM s, (SELECT min(ret) AS lo, max(ret) AS hi FROM s)
         UNION ALL SELECT 'max-sharpe', *, row_number() OVER (ORDER BY sharpe DESC NULLS LAST, portfolio DESC) FROM s UNION ALL SELECT 'min-vol', *, row_number() OVER (ORDER BY vol, portfolio) FROM s)
       SELECT kind, CAST(portfolio AS INT) AS portfolio, {Rs('ret', 'vol', 'sharpe')} FROM k WHERE rn = 1""")
def _(spark, d):
    rets = pf.with_returns(pf.dense_closes(sy.bars(spark, d))).where("ret is not null").select("ticker", "date", "ret")
    rets = durable(rets, "returns")
    scan = durable(po.evaluate(po.candidate_portfolios(rets.select("ticker")), po.expected_returns(rets), po.covariances(rets)), "evaluated")
    return po.frontier_scan(scan).select("kind", "portfolio", *r6s("ret", "vol", "sharpe"))


def _bonds(spark, d):
    return bd.bond_metrics(sy.bond_bars(spark, d), sy.bond_params(spark, d))


@query("k59_bond_yields", f"""SELECT secid, tradedate, close, {R('years')} AS years_to_maturity, floor(ytm * 1e4 + 0.5) / 1e4 AS ytm, floor(1e4 * CASE WHEN n <= 0 THEN 0.0 ELSE list_sum(list_transform(generate_series(1, n), lambda t: t * (c + CASE WHEN t = n THEN face ELSE 0 END) / pow(1 + ytm / 200, t))) / list_sum(list_transform(generate_series(1, n), lambda t: (c + CASE WHEN t = n THEN face ELSE 0 END) / pow(1 + ytm / 200, t))) / 2 / (1 + ytm / 200) END + 0.5) / 1e4 AS duration FROM byield""")
def _(spark, d):
    four = lambda c: (F.floor(F.col(c) * 1e4 + 0.5) / 1e4).alias(c)
    return _bonds(spark, d).select("secid", "tradedate", "close", r6("years_to_maturity", "years_to_maturity"), four("ytm"), four("duration"))


@query("k60_duration", f"""SELECT secid, tradedate, {R('CASE WHEN n <= 0 THEN 0.0 ELSE list_sum(list_transform(generate_series(1, n), lambda t: t * (c + CASE WHEN t = n THEN face ELSE 0 END) / pow(1.04, t))) / list_sum(list_transform(generate_series(1, n), lambda t: (c + CASE WHEN t = n THEN face ELSE 0 END) / pow(1.04, t))) / 2 / 1.04 END')} AS duration
       FROM (SELECT secid, tradedate, face, face * coupon / 100 / 2 AS c, CAST(floor(date_diff('day', tradedate, mat) / 365.25 * 2) AS INT) AS n FROM bonds JOIN bparams USING (secid) WHERE mat IS NOT NULL)""")
def _(spark, d):
    years = F.datediff("matdate", "tradedate") / 365.25
    rows = sy.bond_bars(spark, d).join(sy.bond_params(spark, d), "secid").where("matdate is not null")
    return rows.select("secid", "tradedate", r6(bd.modified_duration(F.col("facevalue"), F.col("couponpercent"), years, F.lit(8.0)), "duration"))


# ---------------------------------------------------------------- time series


def _lret(spark, d):
    return ts.log_returns(sy.bars(spark, d))


@query("k63_acf", f"SELECT a.ticker, CAST(k.lag AS BIGINT) AS lag, {R('sum(a.x * b.x) / any_value(a.ss)')} AS acf FROM xs a CROSS JOIN (SELECT unnest(generate_series(1, 25)) AS lag) k JOIN xs b ON b.ticker = a.ticker AND b.i = a.i - k.lag GROUP BY 1, 2")
def _(spark, d):
    return ts.acf(_lret(spark, d)).select("ticker", *big("lag"), r6("acf", "acf"))


@query("k63_pacf", f"""WITH RECURSIVE r AS (SELECT ticker, list(acf ORDER BY lag) AS rho FROM acf WHERE acf IS NOT NULL AND lag < n GROUP BY 1),
       d AS (SELECT ticker, rho, 1 AS k, [rho[1]] AS phi FROM r UNION ALL SELECT ticker, rho, k + 1, list_transform(list_zip(phi, list_reverse(phi)), lambda z: z[1] - l * z[2]) || [l] FROM
       (SELECT *, (rho[k + 1] - list_dot_product(phi, list_reverse(rho[1:k]))) / (1 - list_dot_product(phi, rho[1:k])) AS l FROM d WHERE k < len(rho)))
       SELECT ticker, CAST(k AS BIGINT) AS lag, {R('phi[k]')} AS pacf FROM d""")
def _(spark, d):
    return ts.pacf(ts.acf(_lret(spark, d))).select("ticker", *big("lag"), r6("pacf", "pacf"))


def _tail(x: str, df: int) -> str:
    return f"exp(-({x}) / 2) * list_sum(list_transform(generate_series(0, {df // 2 - 1}), lambda k: pow(({x}) / 2, k) / gamma(k + 1.0)))"


@query("k64_portmanteau", "SELECT ticker, CAST(m AS BIGINT) AS lags, " + f"{R('lb')} AS ljung_box, {R('CASE WHEN m = 10 THEN ' + _tail('lb', 10) + ' ELSE ' + _tail('lb', 20) + ' END')} AS ljung_box_p, {R('bp')} AS box_pierce, {R('CASE WHEN m = 10 THEN ' + _tail('bp', 10) + ' ELSE ' + _tail('bp', 20) + ' END')} AS box_pierce_p" + """ FROM (SELECT ticker, m, max(n) * (max(n) + 2) * sum(acf * acf / (n - lag)) AS lb, max(n) * sum(acf * acf) AS bp FROM acf, (SELECT unnest([10, 20]) AS m) WHERE lag <= m AND lag < n GROUP BY 1, 2)""")
def _(spark, d):
    return ts.portmanteau(ts.acf(_lret(spark, d))).select("ticker", *big("lags"), *r6s("ljung_box", "ljung_box_p", "box_pierce", "box_pierce_p"))


def _lagged_sql(rows: str, kept: int, least: int) -> str:
    """Parts ``l`` to ``e``: the values x of ``rows`` (g, date, x) with a value ``least`` before them, their Gram matrix with ``kept`` lags in
    front, and the matrix after each step of an elimination."""
    size = kept + 2
    z = ["1.0", *[f"l{k}" for k in range(1, kept + 1)], "x"]
    sums = ", ".join(f"sum({z[i]} * {z[j]})" for i in range(size) for j in range(size))
    step = f"list_transform(range({size * size}), lambda p: m[p + 1] - m[(p // {size}) * {size} + k + 1] * m[k * {size} + p % {size} + 1] / m[k * {size} + k + 1])"
    return f"""l AS (SELECT g, x, {', '.join(f'lag(x, {k}) OVER w AS l{k}' for k in sorted({*range(1, kept + 1), least}))} FROM ({rows}) WINDOW w AS (PARTITION BY g ORDER BY date)),
      s AS (SELECT g, count(*) AS n, [{sums}] AS m FROM l WHERE l{least} IS NOT NULL GROUP BY 1),
      e AS (SELECT g, n, 0 AS k, m FROM s UNION ALL SELECT g, n, k + 1, {step} FROM e WHERE k < {kept + 1})"""


@query("k65_arch_lm", f"""WITH RECURSIVE {_lagged_sql("SELECT ticker AS g, date, ret * ret AS x FROM lret", 10, 10)},
       f AS (SELECT g, n * (1 - max(CASE WHEN k = 11 THEN m[144] END) / max(CASE WHEN k = 1 THEN m[144] END)) AS lm FROM e WHERE n > 20 GROUP BY g, n)
       SELECT t.ticker, {R('lm')} AS arch_lm, {R(_tail('lm', 10))} AS arch_lm_p FROM (SELECT DISTINCT ticker FROM lret) t LEFT JOIN f ON f.g = t.ticker""")
def _(spark, d):
    return ts.arch_lm(_lret(spark, d)).select("ticker", *r6s("arch_lm", "arch_lm_p"))


@query("k62_stationarity")
def _(spark, d):
    return ts.stationarity(_lret(spark, d)).select("ticker", "n", r6("adf", "adf"), "adf_lags", r6("adf_p", "adf_p"), r6("kpss", "kpss"), "kpss_lags", r6("kpss_p", "kpss_p"))


@query("k62_kpss", f"""WITH RECURSIVE x AS (SELECT ticker, row_number() OVER w AS i, ret - avg(ret) OVER (PARTITION BY ticker) AS e, count(*) OVER (PARTITION BY ticker) AS n FROM lret WINDOW w AS (PARTITION BY ticker ORDER BY date)),
       c AS (SELECT a.ticker, a.i - b.i AS k, sum(a.e * b.e) AS c FROM x a JOIN x b ON b.ticker = a.ticker AND b.i BETWEEN a.i - 12 AND a.i WHERE a.i - b.i <= floor(pow(a.n, 2.0 / 9)) GROUP BY 1, 2),
       l AS (SELECT x.ticker, n, least(floor(1.1447 * pow(pow(s, 2), 1.0 / 3) * pow(n, 1.0 / 3)), n - 1)::BIGINT AS band FROM (SELECT DISTINCT ticker, n FROM x WHERE n > 30) x
             JOIN (SELECT ticker, sum(2.0 * k * c) / sum(CASE WHEN k = 0 THEN c ELSE 2.0 * c END) AS s FROM c GROUP BY 1) c ON c.ticker = x.ticker),
       v AS (SELECT a.ticker, sum(CASE WHEN a.i = b.i THEN 1.0 ELSE 2 * (1 - (a.i - b.i) / (l.band + 1.0)) END * a.e * b.e) AS v FROM x a JOIN l ON l.ticker = a.ticker JOIN x b ON b.ticker = a.ticker AND b.i BETWEEN a.i - l.band AND a.i GROUP BY 1),
       y AS (SELECT ticker, sum(r * r) AS area FROM (SELECT ticker, sum(e) OVER (PARTITION BY ticker ORDER BY i) AS r FROM x) GROUP BY 1),
       k AS (SELECT l.ticker, l.n, band, area / l.n / v AS kpss FROM l JOIN v ON v.ticker = l.ticker JOIN y ON y.ticker = l.ticker)
       SELECT ticker, CAST(n AS BIGINT) AS n, {R('kpss')} AS kpss, band AS kpss_lags, {R('CASE WHEN kpss <= 0.347 THEN 0.1 WHEN kpss <= 0.463 THEN 0.1 + (kpss - 0.347) * ((0.05 - 0.1) / (0.463 - 0.347)) WHEN kpss <= 0.574 THEN 0.05 + (kpss - 0.463) * ((0.025 - 0.05) / (0.574 - 0.463)) WHEN kpss <= 0.739 THEN 0.025 + (kpss - 0.574) * ((0.01 - 0.025) / (0.739 - 0.574)) ELSE 0.01 END')} AS kpss_p FROM k""")
def _(spark, d):
    return ts.kpss(_lret(spark, d)).select("ticker", "n", r6("kpss", "kpss"), "kpss_lags", r6("kpss_p", "kpss_p"))


_STEPS = "SELECT ticker || '|0' AS g, date, ret AS x FROM lret WHERE ticker IN (SELECT ticker FROM lret GROUP BY 1 HAVING count(*) > 60) UNION ALL SELECT ticker || '|1', date, ret - lag(ret) OVER (PARTITION BY ticker ORDER BY date) FROM lret WHERE ticker IN (SELECT ticker FROM lret GROUP BY 1 HAVING count(*) > 60)"


@query("k66_arma_orders")
def _(spark, d):
    return ts.arma_grid(_lret(spark, d)).select("ticker", *big("p", "d", "q"), *r6s("aic", "bic"), *big("rank"))


@query("k66_ar_orders", f"""WITH RECURSIVE {_lagged_sql(f"SELECT * FROM ({_STEPS}) WHERE x IS NOT NULL", 3, 15)}
       SELECT split_part(g, '|', 1) AS ticker, CAST(k - 1 AS BIGINT) AS p, CAST(split_part(g, '|', 2) AS BIGINT) AS d, {R('n * ln(m[25] / n) + 2 * k')} AS aic, {R('n * ln(m[25] / n) + ln(n) * k')} AS bic FROM e WHERE k > 1""")
def _(spark, d):
    return ts.arma_grid(_lret(spark, d)).where("q = 0").select("ticker", *big("p", "d"), *r6s("aic", "bic"))


_GARCH = f"""gx AS (SELECT ticker, date, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS i, (ret - avg(ret) OVER (PARTITION BY ticker)) * 100 AS e, greatest(var_pop(ret) OVER (PARTITION BY ticker) * 1e4, 1e-12) AS v
         FROM lret WHERE ticker IN (SELECT ticker FROM lret GROUP BY 1 HAVING count(*) > 60)),
       gs AS (SELECT DISTINCT ticker, beta, 0::BIGINT AS i, 0.0::DOUBLE AS s FROM gx, (SELECT unnest([{', '.join(f'{b}::DOUBLE' for b in ts.GARCH_BETAS)}]) AS beta)
         UNION ALL SELECT gs.ticker, beta, gs.i + 1, beta * s + e * e FROM gs JOIN gx ON gx.ticker = gs.ticker AND gx.i = gs.i),
       gh AS (SELECT gx.ticker, date, gx.i, e, alpha, beta, v * pow(beta, gx.i) + v * (1 - alpha - beta) * (1 - pow(beta, gx.i)) / (1 - beta) + alpha * s AS h FROM gx JOIN gs ON gs.ticker = gx.ticker AND gs.i = gx.i,
         (SELECT unnest([{', '.join(f'{a}::DOUBLE' for a in ts.GARCH_ALPHAS)}]) AS alpha) WHERE alpha + beta < 0.999),
       gb AS (SELECT ticker, arg_max(alpha, ll) AS alpha, arg_max(beta, ll) AS beta FROM (SELECT ticker, alpha, beta, sum(-0.5 * (ln(h) + e * e / h)) AS ll FROM gh GROUP BY 1, 2, 3) GROUP BY 1),
       garch AS (SELECT ticker, date, i, alpha, beta, sqrt(h) AS cond_vol, e / sqrt(h) AS std_resid FROM gh JOIN gb USING (ticker, alpha, beta))"""


@query("k67_garch", f"WITH RECURSIVE {_GARCH} SELECT ticker, date, alpha, beta, {Rs('cond_vol', 'std_resid')} FROM garch")
def _(spark, d):
    return ts.residual_diagnostics(_lret(spark, d)).select("ticker", "date", "alpha", "beta", *r6s("cond_vol", "std_resid"))


@query("k67_garch_2_2")
def _(spark, d):
    return ts.residual_diagnostics(_lret(spark, d), 2, 2).select("ticker", "date", "alpha", "beta", *r6s("cond_vol", "std_resid"))


@query("k71_residual_acf", f"""WITH RECURSIVE {_GARCH}, q AS (SELECT ticker, i, pow(std_resid, 2) - avg(pow(std_resid, 2)) OVER (PARTITION BY ticker) AS x FROM garch),
       ss AS (SELECT ticker, sum(x * x) AS ss FROM q GROUP BY 1)
       SELECT a.ticker, CAST(a.i - b.i AS BIGINT) AS lag, {R('sum(a.x * b.x) / any_value(ss)')} AS acf FROM q a JOIN q b ON b.ticker = a.ticker AND b.i BETWEEN a.i - 25 AND a.i - 1 JOIN ss ON ss.ticker = a.ticker GROUP BY 1, 2""")
def _(spark, d):
    return ts.acf(ts.residual_diagnostics(_lret(spark, d)), "squared").select("ticker", *big("lag"), r6("acf", "acf"))


_NAIVE = "naive AS (SELECT ticker, date, ret AS actual, p AS forecast, ret - p AS error FROM (SELECT *, lag(ret) OVER (PARTITION BY ticker ORDER BY date) AS p FROM lret) WHERE p IS NOT NULL)"


@query("d17_forecast_errors", f"WITH RECURSIVE {_NAIVE} SELECT ticker, count(*) AS n, {R('sqrt(avg(error * error))')} AS rmse, {R('avg(abs(error))')} AS mae FROM naive GROUP BY 1")
def _(spark, d):
    return ts.forecast_errors(ts.persistence_forecast(_lret(spark, d))).select("ticker", "n", *r6s("rmse", "mae"))


@query("e6_rolling_rmse", f"""WITH RECURSIVE {_NAIVE}, n AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date) AS i, greatest(least(20, count(*) OVER (PARTITION BY ticker) // 3), 1) AS w FROM naive),
       s AS (SELECT a.ticker, a.date, a.i, a.w, sum(b.error * b.error) AS ss FROM n a JOIN n b ON b.ticker = a.ticker AND b.i > a.i - a.w AND b.i <= a.i GROUP BY 1, 2, 3, 4)
       SELECT ticker, date, {R('CASE WHEN i >= w THEN sqrt(ss / w) END')} AS rmse FROM s""")
def _(spark, d):
    return ts.rolling_rmse(ts.persistence_forecast(_lret(spark, d))).select("ticker", "date", r6("rmse", "rmse"))


@query("k69_persistence", f"""WITH RECURSIVE {_NAIVE}, r AS (SELECT ticker, actual, forecast, CASE WHEN forecast > 0 THEN actual ELSE 0.0 END AS r FROM naive)
       SELECT ticker, {R('(exp(sum(r)) - 1) * 100')} AS total_pct, {R('(exp(sum(actual)) - 1) * 100')} AS hold_pct, {R('avg(r) / nullif(stddev_samp(r), 0) * sqrt(252.0)')} AS sharpe, {R('100 * avg(CASE WHEN forecast > 0 THEN 1 ELSE 0 END)')} AS long_pct FROM r GROUP BY 1""")
def _(spark, d):
    return ts.long_cash(ts.persistence_forecast(_lret(spark, d))).select("ticker", *r6s("total_pct", "hold_pct", "sharpe", "long_pct"))


@query("k70_steady_path", f"""WITH RECURSIVE f AS (SELECT ticker, avg(ret) AS f, 1.96 * stddev_samp(ret) AS h FROM lret GROUP BY 1),
       b AS (SELECT ticker, max(date) AS last, arg_max(close, date) AS px FROM bars GROUP BY 1),
       c AS (SELECT b.ticker, CAST(last + CAST(k AS INTEGER) AS DATE) AS date, px, f, h, row_number() OVER (PARTITION BY b.ticker ORDER BY k) AS step FROM b JOIN f ON f.ticker = b.ticker, (SELECT unnest(generate_series(1, 24)) AS k) WHERE h IS NOT NULL AND isodow(last + CAST(k AS INTEGER)) < 6)
       SELECT ticker, date, {R('px * exp(step * f)')} AS price, {R('px * exp(step * (f - h))')} AS low, {R('px * exp(step * (f + h))')} AS high FROM c WHERE step <= 10""")
def _(spark, d):
    bars = sy.bars(spark, d)
    return ts.forward_path(bars, ts.steady_steps(ts.log_returns(bars))).select("ticker", "date", *r6s("price", "low", "high"))


def _forecasts(spark, d):
    return ts.walk_forward_forecast(_lret(spark, d))


@query("k68_forecast_errors")
def _(spark, d):
    return ts.forecast_errors(_forecasts(spark, d)).select("ticker", "n", *r6s("rmse", "mae"))


@query("k68_rolling_rmse")
def _(spark, d):
    return ts.rolling_rmse(_forecasts(spark, d)).select("ticker", "date", r6("rmse", "rmse"))


@query("k69_long_cash")
def _(spark, d):
    return ts.long_cash(_forecasts(spark, d)).select("ticker", *r6s("total_pct", "hold_pct", "sharpe", "long_pct"))


@query("k70_forward_path")
def _(spark, d):
    bars = sy.bars(spark, d)
    return ts.forward_path(bars, ts.forecast_steps(ts.log_returns(bars))).select("ticker", "date", *r6s("price", "low", "high"))
