"""SQL of the derived market tables for DuckDB, as named parts of a WITH clause."""

from __future__ import annotations

from ..sources import synthetic as s


def r6(x: str) -> str:
    """Six decimals, ten digits of numbers from a million on (just more than half up), null for NaN: by expressions that both engines evaluate alike."""
    return f"list_transform([CAST(({x}) AS DOUBLE)], lambda v: CASE WHEN isnan(v) THEN NULL WHEN abs(v) < 1e6 THEN floor(v * 1e6 + 0.5) / 1e6 ELSE CAST(format('{{:.9e}}', v * (1 + 2e-12)) AS DOUBLE) END)[1]"


_BAR = "CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)"
_VALUES = f"{_BAR} AS value_rub, SUM(l_quantity) AS volume, MIN(l_extendedprice / l_quantity) AS low, MAX(l_extendedprice / l_quantity) AS high, {_BAR} / SUM(l_quantity) AS close"

#: In order: a part may use those above it.
PARTS = {
    "bars": f"SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS date, {_VALUES} FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2",
    "boards": f"SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS date, l_returnflag AS boardid, {_VALUES} FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3",
    "idx": f"SELECT CAST(l_shipdate AS DATE) AS date, {_BAR} / SUM(l_quantity) AS close, {_BAR} AS volume FROM lineitem GROUP BY 1",
    "tk": "SELECT DISTINCT p_brand AS ticker, CAST(regexp_extract(p_brand, '(\\d+)', 1) AS INT) AS n FROM part",
    "sectors": "SELECT ticker, 'S' || (n % 5) AS sector FROM tk WHERE n NOT IN (24, 25)",
    "dividends": "SELECT ticker, make_date(y, 6, 1 + n % 20) AS closing_date, CAST(500 + 10 * n AS DOUBLE) AS dividend_value FROM tk, (SELECT unnest(generate_series(1996, 2001)) AS y)",
    "shares": "SELECT ticker, make_date(1995 + q // 4, 1 + 3 * (q % 4), 1) AS date, CAST(1000 * n + 10 * q AS DOUBLE) AS shares FROM tk, (SELECT unnest(generate_series(0, 27)) AS q) WHERE n <> 25",
    "splits": f"SELECT ticker, date, CAST(ratio AS DOUBLE) AS ratio, kind FROM {s.SPLITS} AS t(ticker, date, ratio, kind)",
    "renames": f"SELECT * FROM {s.RENAMES} AS t(old, new, date)",
    "key_rate": f"SELECT date, CAST(rate AS DOUBLE) AS rate FROM {s.KEY_RATE} AS t(date, rate)",
    "jumps": """SELECT ticker, date, ratio, kind, coalesce(before > 0 AND after > 0 AND abs(ln((after / before) * ratio)) < ln(2.5), false) AS jump
        FROM (SELECT s.*, (SELECT arg_max(b.close, b.date) FROM bars b WHERE b.ticker = s.ticker AND b.date < s.date) AS before,
              (SELECT arg_min(b.close, b.date) FROM bars b WHERE b.ticker = s.ticker AND b.date >= s.date) AS after FROM splits s)""",
    "sfac": "SELECT b.ticker, b.date, product(j.ratio) AS factor FROM bars b JOIN jumps j ON b.ticker = j.ticker AND b.date < j.date AND (j.kind = 'price' OR (j.kind = 'auto' AND j.jump)) GROUP BY 1, 2",
    "adj": "SELECT b.ticker, b.date, b.close AS raw, b.close / coalesce(factor, 1.0) AS close, b.volume * coalesce(factor, 1.0) AS volume, value_rub FROM bars b LEFT JOIN sfac f ON b.ticker = f.ticker AND b.date = f.date",
    "divf": """SELECT ticker, closing_date, 1 - y AS factor FROM (SELECT d.ticker, closing_date, CASE WHEN dividend_value / raw > 0 AND dividend_value / raw < 0.5 THEN dividend_value / raw
        WHEN dividend_value / close > 0 AND dividend_value / close < 0.5 THEN dividend_value / close END AS y FROM dividends d ASOF JOIN adj a ON d.ticker = a.ticker AND d.closing_date >= a.date) WHERE y IS NOT NULL""",
    "tr": "SELECT a.ticker, a.date, a.raw, a.close * coalesce(p, 1.0) AS adj_close, a.value_rub FROM adj a LEFT JOIN (SELECT a.ticker, a.date, product(factor) AS p FROM adj a JOIN divf d ON a.ticker = d.ticker AND a.date <= d.closing_date GROUP BY 1, 2) d ON a.ticker = d.ticker AND a.date = d.date",
    "ashares": """SELECT s.ticker, s.date, s.shares * coalesce(f, 1.0) AS shares FROM shares s LEFT JOIN (SELECT s.ticker, s.date, product(CASE WHEN kind = 'shares' THEN 1 / ratio ELSE ratio END) AS f FROM shares s
        JOIN jumps j ON s.ticker = j.ticker AND s.date < j.date AND (kind = 'shares' OR (kind = 'auto' AND NOT jump)) GROUP BY 1, 2) f ON s.ticker = f.ticker AND s.date = f.date""",
    "cap": """SELECT b.ticker, b.date, b.close, b.value_rub, coalesce(s.shares, f.shares) AS shares, b.close * coalesce(s.shares, f.shares) AS market_cap FROM bars b ASOF LEFT JOIN ashares s ON b.ticker = s.ticker AND b.date >= s.date
        LEFT JOIN (SELECT ticker, arg_min(shares, date) AS shares FROM ashares GROUP BY 1) f ON b.ticker = f.ticker""",
    "cal": "SELECT date, row_number() OVER (ORDER BY date) AS ord FROM (SELECT DISTINCT date FROM bars)",
    "dense": "SELECT t.ticker, c.date, c.ord, b.close AS px FROM (SELECT DISTINCT ticker FROM bars) t, cal c LEFT JOIN bars b ON b.ticker = t.ticker AND b.date = c.date",
    "dret": "SELECT *, px / lag(px) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret FROM dense",
    "bounds": "SELECT CAST(max(date) - INTERVAL 3 MONTH AS DATE) AS s, max(date) AS e FROM bars",
    "perf": """SELECT ticker, first_date, last_date, first_price, last_price, (last_price / first_price - 1) * 100 AS price_pct, first_cap, last_cap, last_cap / nullif(first_cap, 0) * 100 - 100 AS cap_pct, last_cap - first_cap AS cap_change
        FROM (SELECT ticker, count(*) AS n, min(date) AS first_date, max(date) AS last_date, first(close ORDER BY date) AS first_price, last(close ORDER BY date) AS last_price, first(market_cap ORDER BY date) AS first_cap, last(market_cap ORDER BY date) AS last_cap
              FROM cap, bounds WHERE date BETWEEN s AND e GROUP BY 1) WHERE n >= 2 AND first_price > 0 AND last_price IS NOT NULL""",
    "ypanel": "SELECT *, px / lag(px) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret, last_value(px IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY date) AS fpx FROM (SELECT t.ticker, c.date, b.close AS px FROM (SELECT DISTINCT b.ticker FROM bars b, (SELECT max(date) AS e FROM bars) m WHERE b.date >= CAST(e - INTERVAL 1 YEAR AS DATE)) t, (SELECT date FROM cal, (SELECT max(date) AS e FROM bars) m WHERE date >= CAST(e - INTERVAL 1 YEAR AS DATE)) c LEFT JOIN bars b ON b.ticker = t.ticker AND b.date = c.date)",
    "iret": "SELECT date, close, close / lag(close) OVER (ORDER BY date) - 1 AS idx FROM idx",
    "risk": """SELECT ticker, CAST(count(ret) AS BIGINT) AS n, CASE WHEN count(ret) >= 60 THEN stddev_samp(ret) * sqrt(252.0) * 100 END AS vol, min(dd) * 100 AS max_drawdown, (last(fpx ORDER BY date) / max(px) - 1) * 100 AS from_high,
        CASE WHEN count(ret) >= 60 THEN covar_samp(ret, idx) / (SELECT var_samp(i.idx) FROM iret i WHERE i.date IN (SELECT date FROM ypanel)) END AS beta
        FROM (SELECT y.*, i.idx, fpx / max(fpx) OVER w - 1 AS dd FROM ypanel y LEFT JOIN iret i ON y.date = i.date WINDOW w AS (PARTITION BY ticker ORDER BY y.date)) GROUP BY 1""",
    "ipct": "SELECT (last(close ORDER BY date) / first(close ORDER BY date) - 1) * 100 AS index_pct FROM idx, (SELECT CAST(max(date) - INTERVAL 3 MONTH AS DATE) AS s FROM idx) WHERE date >= s",
    "enriched": "SELECT p.*, vol, max_drawdown, from_high, beta, price_pct / nullif(vol * sqrt(greatest(date_diff('day', first_date, last_date), 1) / 365.25), 0) AS sigma_move, price_pct - beta * index_pct AS alpha FROM perf p LEFT JOIN risk r ON p.ticker = r.ticker, ipct",
    "mbase": "SELECT ticker, last_day(date) AS month, last(close ORDER BY date) AS px, last(adj_close ORDER BY date) AS tr FROM (SELECT ticker, date, raw AS close, adj_close FROM tr) WHERE close > 0 GROUP BY 1, 2",
    "mcal": "SELECT month, row_number() OVER (ORDER BY month) AS ord FROM (SELECT DISTINCT month FROM mbase)",
    "dvol": "SELECT ticker, date, CASE WHEN count(ret) OVER w >= 21 THEN stddev_samp(ret) OVER w * sqrt(252.0) END AS v FROM dret WINDOW w AS (PARTITION BY ticker ORDER BY date ROWS 62 PRECEDING)",
    "panel": """SELECT ticker, month, ord, px, turnover, px / lag(px) OVER w - 1 AS ret, vol, tr / lag(tr, 12) OVER w - px / lag(px, 12) OVER w AS div FROM (
        SELECT t.ticker, c.month, c.ord, m.px, m.tr, u.turnover, v.vol FROM (SELECT DISTINCT ticker FROM mbase) t, mcal c LEFT JOIN mbase m ON m.ticker = t.ticker AND m.month = c.month
        LEFT JOIN (SELECT ticker, last_day(date) AS month, sum(value_rub) AS turnover FROM bars GROUP BY 1, 2) u ON u.ticker = t.ticker AND u.month = c.month
        LEFT JOIN (SELECT ticker, last_day(date) AS month, last(v ORDER BY date) AS vol FROM dvol WHERE v IS NOT NULL GROUP BY 1, 2) v ON v.ticker = t.ticker AND v.month = c.month) WINDOW w AS (PARTITION BY ticker ORDER BY ord)""",
    "sig": "SELECT *, lag(px, 1) OVER (PARTITION BY ticker ORDER BY ord) / lag(px, 7) OVER (PARTITION BY ticker ORDER BY ord) - 1 AS mom FROM panel",
    "uni": "SELECT *, row_number() OVER (PARTITION BY month ORDER BY turnover DESC NULLS LAST, ticker) AS p, count(turnover) OVER (PARTITION BY month) AS have FROM sig",
    "ranked": "SELECT *, greatest(1, floor(n * 0.2)) AS k FROM (SELECT ticker, month, ord, mom, vol, count(*) OVER (PARTITION BY month) AS n, row_number() OVER (PARTITION BY month ORDER BY mom DESC, ticker) AS up, row_number() OVER (PARTITION BY month ORDER BY mom, ticker) AS down FROM uni WHERE mom IS NOT NULL AND (have = 0 OR (p <= 15 AND turnover IS NOT NULL)))",
    "wreb": "SELECT ticker, month, ord, 1.0 / k AS weight FROM ranked WHERE up <= k",
    "whold": "SELECT w.ticker, c.ord, c.month, sum(weight / 3) AS weight FROM wreb w JOIN mcal c ON c.ord BETWEEN w.ord AND w.ord + 2 GROUP BY 1, 2, 3",
    "gross": "SELECT w.ord + 1 AS ord, sum(weight * CASE WHEN ret IS NULL OR ret <= -1 THEN 0 ELSE ret END) AS g FROM whold w LEFT JOIN panel p ON p.ticker = w.ticker AND p.ord = w.ord + 1 GROUP BY 1",
    "moves": "SELECT ord, sum(abs(d)) / 2 AS turnover FROM (SELECT ticker, ord, sum(w) AS d FROM (SELECT ticker, ord, weight AS w FROM whold UNION ALL SELECT ticker, ord + 1, -weight FROM whold) GROUP BY 1, 2) GROUP BY 1",
    "bt": "SELECT month, c.ord, coalesce(g, 0) AS ret_gross, coalesce(turnover, 0) AS turnover, coalesce(turnover, 0) * 10 / 1e4 AS tc, coalesce(g, 0) - coalesce(turnover, 0) * 10 / 1e4 AS ret_net FROM mcal c LEFT JOIN gross g ON g.ord = c.ord LEFT JOIN moves m ON m.ord = c.ord WHERE c.ord > 8",
    "bench": "SELECT month, px / lag(px) OVER (ORDER BY month) - 1 AS bench FROM (SELECT last_day(date) AS month, last(close ORDER BY date) AS px FROM idx GROUP BY 1)",
    "rf": "SELECT month, coalesce(k.rate, (SELECT arg_min(rate, date) FROM key_rate)) / 100 / 12 AS rf FROM mcal m ASOF LEFT JOIN key_rate k ON m.month >= k.date",
    "then_now": """SELECT t.ticker, then_px, then_cap, now_px, now_cap, (now_px / then_px - 1) * 100 AS pct FROM (SELECT ticker, last(close ORDER BY date) AS then_px, last(market_cap ORDER BY date) AS then_cap FROM cap WHERE close > 0 AND date BETWEEN DATE '1999-12-30' - 45 AND DATE '1999-12-30' GROUP BY 1) t
        JOIN (SELECT ticker, max(date) AS d, last(close ORDER BY date) AS now_px, last(market_cap ORDER BY date) AS now_cap FROM cap WHERE close > 0 GROUP BY 1) n ON t.ticker = n.ticker WHERE d >= (SELECT max(date) FROM cap) - 30""",
    "vret": "SELECT * FROM (SELECT ticker, date, ln(close / lag(close) OVER (PARTITION BY ticker ORDER BY date)) AS ret FROM bars JOIN (SELECT ticker AS t, median(close) AS mid FROM bars GROUP BY 1) ON ticker = t WHERE close > 0 AND close BETWEEN 0.01 * mid AND 1000 * mid) WHERE ret IS NOT NULL",
    "lret": "SELECT * FROM (SELECT ticker, date, ln(close / lag(close) OVER (PARTITION BY ticker ORDER BY date)) AS ret FROM bars WHERE close > 0) WHERE ret IS NOT NULL",
    "xs": "SELECT *, sum(x * x) OVER (PARTITION BY ticker) AS ss, count(*) OVER (PARTITION BY ticker) AS n FROM (SELECT ticker, row_number() OVER (PARTITION BY ticker ORDER BY date) AS i, ret - avg(ret) OVER (PARTITION BY ticker) AS x FROM lret)",
    "mc": "SELECT ticker, date, close FROM (SELECT ticker, last_day(date) AS date, last(close ORDER BY date) AS close FROM bars WHERE ticker IN (SELECT ticker FROM bars GROUP BY 1 HAVING min(date) <= DATE '1995-01-01' + 30 AND max(date) >= (SELECT max(date) FROM bars) - 30) GROUP BY 1, 2)",
    "cc": "SELECT * FROM mc WHERE date IN (SELECT date FROM mc GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT ticker) FROM mc))",
    "cr": "SELECT * FROM (SELECT ticker, date, close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 AS ret FROM cc) WHERE ret IS NOT NULL",
    "bonds": "SELECT 'B' || l_partkey AS secid, CAST(l_shipdate AS DATE) AS tradedate, 60 + (sum(l_quantity) % 80) AS close FROM lineitem GROUP BY 1, 2",
    "acf": "SELECT a.ticker, k.lag, sum(a.x * b.x) / any_value(a.ss) AS acf, any_value(a.n) AS n FROM xs a CROSS JOIN (SELECT unnest(generate_series(1, 25)) AS lag) k JOIN xs b ON b.ticker = a.ticker AND b.i = a.i - k.lag GROUP BY 1, 2",
    "bparams": "SELECT 'B' || p_partkey AS secid, 1000.0::DOUBLE AS face, CAST(p_size % 13 AS DOUBLE) AS coupon, CASE WHEN p_size % 10 <> 0 THEN CAST(DATE '1998-01-01' + to_months(p_size * 2) AS DATE) END AS mat FROM part",
    # bonds: the yield by halving, 50 times, and the duration at it
    "byield": """SELECT secid, tradedate, close, years, face, c, n, CASE WHEN mat IS NULL THEN NULL WHEN n <= 0 THEN 0.0 WHEN px >= c * (1 - pow(0.75, -n)) / -0.25 + face * pow(0.75, -n) THEN -50.0 WHEN px <= c * (1 - pow(3.5, -n)) / 2.5 + face * pow(3.5, -n) THEN 500.0
        ELSE 100 * list_reduce([-0.5] || list_transform(generate_series(1, 50), lambda k: 5.5 / pow(2.0, k)), lambda y, s: CASE WHEN c * CASE WHEN abs(y + s) < 1e-12 THEN n ELSE (1 - pow(1 + (y + s) / 2, -n)) / ((y + s) / 2) END + face * pow(1 + (y + s) / 2, -n) > px THEN y + s ELSE y END) END AS ytm
        FROM (SELECT b.secid, b.tradedate, b.close, face, mat, b.close / 100 * face AS px, face * coupon / 100 / 2 AS c, date_diff('day', tradedate, mat) / 365.25 AS years, CAST(floor(date_diff('day', tradedate, mat) / 365.25 * 2) AS INT) AS n FROM bonds b LEFT JOIN bparams USING (secid))""",
    # strategies with the trend gate and volatility scaling
    "trend": """SELECT last_day(date) AS month, CAST(arg_max(f, date) > arg_max(s, date) AS DOUBLE) AS ewmac, CASE WHEN arg_max(ma, date) IS NOT NULL THEN CAST(last(close ORDER BY date) > arg_max(ma, date) AS DOUBLE) END AS above_ma
        FROM (SELECT i.date, i.close, CASE WHEN count(*) OVER w >= 100 THEN avg(close) OVER w END AS ma, list_reduce(list(close) OVER u, lambda acc, x: acc * (1 - 2.0 / 17) + x * (2.0 / 17)) AS f, list_reduce(list(close) OVER u, lambda acc, x: acc * (1 - 2.0 / 65) + x * (2.0 / 65)) AS s FROM idx i WINDOW w AS (ORDER BY date ROWS 199 PRECEDING), u AS (ORDER BY date ROWS UNBOUNDED PRECEDING)) GROUP BY 1""",
    "wgate": "SELECT w.ticker, w.ord, w.month, w.weight * coalesce(t.ewmac, 1.0) AS weight FROM whold w LEFT JOIN trend t ON t.month = w.month",
    "ggross": "SELECT c.ord, coalesce(g, 0) AS g FROM mcal c LEFT JOIN (SELECT w.ord + 1 AS ord, sum(weight * CASE WHEN ret IS NULL OR ret <= -1 THEN 0 ELSE ret END) AS g FROM wgate w LEFT JOIN panel p ON p.ticker = w.ticker AND p.ord = w.ord + 1 WHERE weight <> 0 GROUP BY 1) x ON x.ord = c.ord",
    "gscale": "SELECT ord, coalesce(least(0.15 / nullif(CASE WHEN count(g) OVER w >= 6 THEN stddev_pop(g) OVER w * sqrt(12.0) END, 0), 2.0), 1.0) AS s FROM ggross WINDOW w AS (ORDER BY ord ROWS 11 PRECEDING)",
    "wscaled": "SELECT w.ticker, w.ord, w.weight * s AS weight FROM wgate w JOIN gscale g ON g.ord = w.ord WHERE w.weight * s <> 0",
    # the grid
    "cfg": "SELECT *, row_number() OVER (ORDER BY lookback, skip, hold, q, long_short) AS config FROM (SELECT unnest([3, 6, 9, 12]) AS lookback), (SELECT unnest([0, 1]) AS skip), (SELECT unnest([1, 3, 6]) AS hold), (SELECT unnest([CAST(0.2 AS DOUBLE), CAST(0.3 AS DOUBLE)]) AS q), (SELECT unnest([false, true]) AS long_short)",
    "gsig": "SELECT * FROM (SELECT c.lookback, c.skip, p.ticker, p.month, p.ord, lag(px, c.skip) OVER w / lag(px, c.lookback + c.skip) OVER w - 1 AS mom FROM panel p, (SELECT DISTINCT lookback, skip FROM cfg) c WINDOW w AS (PARTITION BY c.lookback, c.skip, p.ticker ORDER BY p.ord)) WHERE mom IS NOT NULL",
    "gw": """SELECT lookback, skip, q, long_short, ticker, ord, CASE WHEN long_short AND down <= k THEN -1.0 / k WHEN up <= k THEN 1.0 / k END AS weight FROM (SELECT *, greatest(1, floor(n * q)) AS k FROM (SELECT s.*, c.q, c.long_short, count(*) OVER m AS n, row_number() OVER (m ORDER BY mom DESC, ticker) AS up, row_number() OVER (m ORDER BY mom, ticker) AS down
        FROM gsig s JOIN (SELECT DISTINCT lookback, skip, q, long_short FROM cfg) c ON c.lookback = s.lookback AND c.skip = s.skip WINDOW m AS (PARTITION BY s.lookback, s.skip, c.q, c.long_short, s.month)))""",
    "gheld": "SELECT g.config, w.ticker, m.ord, sum(weight / g.hold) AS weight FROM gw w JOIN cfg g ON g.lookback = w.lookback AND g.skip = w.skip AND g.q = w.q AND g.long_short = w.long_short JOIN mcal m ON m.ord BETWEEN w.ord AND w.ord + g.hold - 1 WHERE weight IS NOT NULL GROUP BY 1, 2, 3",
    "grets": """SELECT g.config, m.month, m.ord, coalesce(x.g, 0) - coalesce(t.t, 0) * 10 / 1e4 AS ret_net FROM cfg g CROSS JOIN mcal m LEFT JOIN (SELECT w.config, w.ord + 1 AS ord, sum(weight * CASE WHEN ret IS NULL OR ret <= -1 THEN 0 ELSE ret END) AS g FROM gheld w LEFT JOIN panel p ON p.ticker = w.ticker AND p.ord = w.ord + 1 WHERE weight <> 0 GROUP BY 1, 2) x ON x.config = g.config AND x.ord = m.ord
        LEFT JOIN (SELECT config, ord, sum(abs(d)) / 2 AS t FROM (SELECT config, ticker, ord, sum(w) AS d FROM (SELECT config, ticker, ord, weight AS w FROM gheld UNION ALL SELECT config, ticker, ord + 1, -weight FROM gheld) GROUP BY 1, 2, 3) GROUP BY 1, 2) t ON t.config = g.config AND t.ord = m.ord WHERE m.ord > g.lookback + g.skip + 1""",
    "gparts": "SELECT r.*, bench, coalesce(rf, 0) AS rf, CASE WHEN spot <= floor(n * CAST(0.6 AS DOUBLE)) THEN 'train' ELSE 'test' END AS part FROM grets r JOIN (SELECT month, bench, row_number() OVER (ORDER BY month) AS spot, count(*) OVER () AS n FROM bench WHERE bench IS NOT NULL AND month IN (SELECT month FROM grets)) c USING (month) LEFT JOIN rf USING (month)",
    "gstats": "SELECT config, part, CASE WHEN product(1 + ret_net) > 0 THEN pow(product(1 + ret_net), 12.0 / count(*)) - 1 END AS cagr, avg(ret_net - rf) / nullif(stddev_pop(ret_net - rf), 0) * sqrt(12.0) AS sharpe FROM gparts GROUP BY 1, 2",
    "walked": "SELECT c.*, a.sharpe AS train_sharpe, b.sharpe AS test_sharpe, a.cagr AS train_cagr, b.cagr AS test_cagr, row_number() OVER (ORDER BY a.sharpe DESC NULLS LAST, c.config) = 1 AS chosen FROM cfg c JOIN gstats a ON a.config = c.config AND a.part = 'train' LEFT JOIN gstats b ON b.config = c.config AND b.part = 'test'",
}


def used(body: str, parts: dict[str, str]) -> list[str]:
    """The parts that a text names, directly or through others, in order."""
    import re

    need: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in parts:
            if name not in need and re.search(rf"\b(FROM|JOIN|,)\s+\(?{name}\b", text):
                need.add(name)
                todo.append(parts[name])
    return [n for n in parts if n in need]


def sql(body: str, **changed: str) -> str:
    """``body`` with the WITH clause that it needs, some parts ``changed``."""
    own = {}
    for name, text in PARTS.items():
        if name in changed:  # the original stays beside it
            own[f"{name}_0"] = text
        own[name] = changed.get(name, text)
    parts = ", ".join(f"{n} AS MATERIALIZED ({own[n]})" for n in used(body, own))
    if not parts:
        return body
    return body.replace("WITH RECURSIVE ", f"WITH RECURSIVE {parts}, ", 1) if body.startswith("WITH RECURSIVE ") else f"WITH {parts} {body}"
