"""Reading, normalising, upserting and writing market tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas
from ..functions.core import keep_last
from ..functions.intervals import near_join
from ..scratch import durable, exists, remove
from . import versions

#: Candle widths by frequency code: minutes, or the unit that a date is cut to.
FREQUENCIES = {1: "1 minute", 10: "10 minutes", 60: "1 hour", 24: "day", 7: "week", 31: "month", 4: "quarter"}
#: Days around an explicit split within which an imported one is the same event.
SAME_EVENT_DAYS = 45


def check_dates(start: str, end: str) -> tuple[dt.date, dt.date]:
    """Both as dates; ValueError for anything but YYYY-MM-DD, or a start after the end."""
    a, b = (dt.datetime.strptime(x, "%Y-%m-%d").date() for x in (start, end))
    if a > b:
        raise ValueError(f"start {start} is after end {end}")
    return a, b


def read_table(spark: SparkSession, path: str, schema: str, start: str | None = None, end: str | None = None, **options: str) -> DataFrame:
    """The stored rows of the version in use; of a table in months only those that hold the dates from ``start`` to ``end``."""
    found = versions.folders(path, versions.latest(spark, path), start, end)
    return spark.read.schema(schema).options(**options).parquet(*found) if found else spark.createDataFrame([], schema)


def read_bars(spark: SparkSession, path: str, tickers: Sequence[str] | None = None, start: str | None = None, end: str | None = None, schema: str = schemas.BARS) -> DataFrame:
    """Stored bars. Ticker and date limits are predicates that Parquet files are skipped by."""
    df = read_table(spark, path, schema, start, end)
    if tickers:
        df = df.where(F.col("ticker").isin([t.strip() for t in tickers] + [t.strip().upper() for t in tickers]))
    if start:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    return df.where(F.col("date") <= F.lit(end).cast("date")) if end else df


def read_one(spark: SparkSession, path: str, key: str, value: str, schema: str) -> DataFrame:
    """The stored rows of one index or bond; FileNotFoundError if there are none, or no table."""
    df = read_table(spark, path, schema).where(F.col(key) == value) if exists(spark, path) else None
    if df is None or df.isEmpty():
        raise FileNotFoundError(f"no rows for {value} in {path}")
    return df


def read_all(spark: SparkSession, path: str, renames: DataFrame | None = None, schema: str = schemas.BARS) -> DataFrame:
    """All securities in one scan; ValueError if nothing is stored. Unreadable files are skipped; Spark logs a warning for each."""
    df = read_table(spark, path, schema, ignoreCorruptFiles="true")
    if df.isEmpty():
        raise ValueError(f"no bars in {path}")
    if renames is None:
        return df
    from ..operators.corporate_actions import apply_renames

    return apply_renames(df, renames)


def registry(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small CSV table with a header; no rows if the file is missing."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).csv(path, header=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def load_shares(sheets: DataFrame) -> DataFrame:
    """Snapshots from landed sheets (sheet, ticker, shares): sheets named by a date, rows with a number."""
    day = F.to_date(F.try_to_timestamp("sheet", F.lit("dd.MM.yyyy")))
    return sheets.select(F.trim("ticker").alias("ticker"), day.alias("date"), F.col("shares").cast("double").alias("shares")).dropna(subset=["date", "shares"])


def load_splits(explicit: DataFrame, payloads: DataFrame | None = None) -> DataFrame:
    """Explicit splits (kind ``price`` unless given) and those of nested JSON ``payload`` documents, without the latter that lie within
    45 days of an explicit one of the same ticker."""
    own = explicit.withColumn("kind", F.coalesce("kind", F.lit("price")) if "kind" in explicit.columns else F.lit("price"))
    if payloads is None:
        return own
    kind = "map<string,array<struct<date:string,ratio:double,kind:string>>>"
    events = payloads.select(F.explode(F.from_json("payload", kind)).alias("ticker", "events")).select("ticker", F.explode("events").alias("e"))
    events = events.select("ticker", F.to_date("e.date").alias("date"), F.when(F.col("e.kind") == "reverse", 1 / F.col("e.ratio")).otherwise(F.col("e.ratio")).alias("ratio"), F.lit("auto").alias("kind"))
    events = near_join(events, own.select("ticker", "date"), ["ticker"], "date", "date", SAME_EVENT_DAYS, "left_anti")
    return own.select("ticker", "date", "ratio", "kind").unionByName(events)


def load_dividends(spark: SparkSession, folder: str) -> DataFrame:
    """Dividends from one CSV for each ticker, named after it; positive values with a date."""
    rows = spark.read.schema("closing_date date, dividend_value double").csv(folder, header=True).select("*", "_metadata.file_name")
    return positive_dividends(rows.select(F.regexp_extract("file_name", r"^(.+)\.csv$", 1).alias("ticker"), "closing_date", "dividend_value"))


def positive_dividends(rows: DataFrame) -> DataFrame:
    return rows.where("closing_date is not null and dividend_value > 0")


def parse_tables(docs: DataFrame, table: str, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of an exchange table in JSON ``payload`` documents, as strings, with the place of each row.

    Three shapes: an object with ``columns`` and ``data``, a list of lists that begins with the header, a list of objects.
    """
    body = docs.select(*keep, F.get_json_object("payload", f"$.{table}").alias("_body"))
    is_object, is_list = F.col("_body").startswith("{"), F.col("_body").rlike(r"^\[\s*\[")
    obj = F.when(is_object, F.from_json("_body", "struct<columns:array<string>,data:array<array<string>>>"))
    lists = F.when(is_list, F.from_json("_body", "array<array<string>>"))
    dicts = F.when(~is_object & ~is_list, F.from_json("_body", "array<map<string,string>>"))
    parsed = body.select(*keep, obj.alias("_obj"), lists.alias("_lists"), dicts.alias("_dicts"))
    heads = F.coalesce(F.col("_obj.columns"), F.try_element_at("_lists", F.lit(1))).alias("_heads")
    cells = F.coalesce(F.col("_obj.data"), F.slice("_lists", 2, F.greatest(F.size("_lists") - 1, F.lit(0))))
    # a document is parsed once, before its rows are told apart; a row only meets the names of its columns
    cell = lambda cells, by_name: F.struct(cells.alias("cells"), by_name.alias("by_name"))
    no_cells, no_names = F.lit(None).cast("array<string>"), F.lit(None).cast("map<string,string>")
    listed = F.coalesce(F.transform(cells, lambda r: cell(r, no_names)), F.transform("_dicts", lambda r: cell(no_cells, r)))
    rows = parsed.select(*keep, heads, F.posexplode(listed).alias("row_pos", "_row"))
    named = F.coalesce(F.map_from_arrays("_heads", F.slice("_row.cells", 1, F.size("_heads"))), F.col("_row.by_name"))
    out = rows.select(*keep, "row_pos", named.alias("_r"))
    return out.select(*keep, "row_pos", *[F.try_element_at("_r", F.lit(c)).alias(c.lower()) for c in columns])


def main_board(rows: DataFrame, *, nulls_win: bool = True) -> DataFrame:
    """One bar for each ticker and date: of the board with the largest turnover, then without those that have no close.

    A missing turnover counts as the largest, as the daily source wants it, unless ``nulls_win`` is off.
    """
    turnover = F.col("value_rub").desc_nulls_first() if nulls_win else F.col("value_rub").desc_nulls_last()
    return keep_last(rows, ["ticker", "date"], turnover, F.col("boardid")).where("close is not null").drop("boardid")


def candle_start(ts: Column, frequency: int) -> Column:
    width = FREQUENCIES[frequency]
    return F.window(ts, width)["start"] if width[0].isdigit() else F.date_trunc(width, ts)


def resample_candles(trades: DataFrame, frequency: int, key: str = "ticker", ts: str = "ts", price: str = "price", order: str | None = None) -> DataFrame:
    """Open, high, low, close, turnover and count for each key and interval. ``order`` breaks ties of time."""
    at = F.struct(ts, order) if order else F.col(ts)
    return trades.groupBy(key, candle_start(F.col(ts), frequency).alias("begin")).agg(
        F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"), F.sum(price).alias("value_rub"), F.count(price).alias("n")
    )


def index_history(rows: DataFrame, ticker: str) -> DataFrame:
    """An index's history from the exchange's columns; ValueError if one is missing."""
    have = {c.lower(): c for c in rows.columns}
    if missing := {"tradedate", "value", "close"} - set(have):
        raise ValueError(f"missing columns: {sorted(missing)}")
    return rows.select(F.lit(ticker).alias("ticker"), F.to_date(have["tradedate"]).alias("date"), F.col(have["close"]).cast("double").alias("close"), F.col(have["value"]).cast("double").alias("volume"))


def bond_list(payloads: DataFrame, segment: str = "TQCB") -> DataFrame:
    """``secid, shortname`` and the typed parameters of the bonds of one board, from landed payloads of any of the three shapes."""
    rows = parse_tables(payloads, "securities", ["SECID", "SHORTNAME", "BOARDID", "FACEVALUE", "COUPONPERCENT", "MATDATE"])
    return rows.where(F.col("boardid") == segment).select("secid", "shortname", *_bond_parameters())


def bond_params(payloads: DataFrame) -> DataFrame:
    """``secid, facevalue, couponpercent, matdate`` (BOND_PARAMS) of every bond in the payloads; what is missing or no number is null."""
    rows = parse_tables(payloads, "securities", ["SECID", "FACEVALUE", "COUPONPERCENT", "MATDATE"])
    return keep_last(rows.where("secid is not null"), ["secid"], F.col("matdate").desc_nulls_last(), F.col("facevalue"), F.col("couponpercent")).select("secid", *_bond_parameters())


def _bond_parameters() -> list[Column]:
    return [*[F.expr(f"try_cast({c} as double)").alias(c) for c in ("facevalue", "couponpercent")], F.expr("try_cast(matdate as date)").alias("matdate")]


def bond_history(pages: DataFrame) -> DataFrame:
    """Bond prices from pages (secid, page_offset, row_pos, tradedate, close, waprice): the last row of each date."""
    typed = pages.select("secid", "page_offset", "row_pos", F.to_date("tradedate").alias("tradedate"), *[F.expr(f"try_cast({c} as double)").alias(c) for c in ("close", "waprice")])
    return keep_last(typed.where("tradedate is not null"), ["secid", "tradedate"], F.desc("page_offset"), F.desc("row_pos")).drop("page_offset", "row_pos")


def last_dates(stored: DataFrame, key: str = "ticker", date: str = "date", *, next_day: bool = False) -> DataFrame:
    """From where each security is to be fetched again: its last stored date, or the day after."""
    last = F.max(date)
    return stored.groupBy(key).agg((F.date_add(last, 1) if next_day else last).alias("since"))


def upsert(stored: DataFrame, new: DataFrame, keys: Sequence[str] = ("ticker", "date"), *order: Column) -> DataFrame:
    """Stored and new rows, where a key is in both the new one. ``order`` decides among new rows of one key."""
    both = stored.withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)), allowMissingColumns=True)
    tie = order or tuple(F.col(c).desc_nulls_last() for c in stored.columns if c not in keys)
    return keep_last(both, list(keys), F.desc("_src"), *tie).drop("_src")


def update_all(stored: DataFrame, landed: DataFrame, *, rebuild: bool = False) -> tuple[DataFrame, DataFrame]:
    """The stored table after an update of all securities, and ``ticker, failures, first_date`` of those that failed.

    ``landed`` has the stored columns as text. A security fails if any of its rows has no date or a value that is no number; it keeps its
    stored rows, and the others are updated, or with ``rebuild`` replaced by what landed.
    """
    good, failed = split_failures(stored, landed)
    before = stored.join(good.select("ticker").distinct(), "ticker", "left_anti") if rebuild else stored
    return upsert(before, good), failed


def split_failures(stored: DataFrame, landed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of ``landed`` the rows of securities without a failure, in the types of ``stored``, and ``ticker, failures, first_date`` of the others."""
    kinds = dict(stored.dtypes)
    own = [c for c in stored.columns if c in landed.columns]
    typed = landed.select(*[F.expr(f"try_cast(`{c}` as {kinds[c]})").alias(c) for c in own], F.exists(F.array(*[F.col(f"`{c}`").isNotNull() & F.expr(f"try_cast(`{c}` as {kinds[c]}) is null") for c in own]), lambda bad: bad).alias("_bad"))
    failed = typed.where(F.col("_bad") | F.col("date").isNull()).groupBy("ticker").agg(F.count("*").alias("failures"), F.min("date").alias("first_date"))
    return typed.drop("_bad").join(failed.select("ticker"), "ticker", "left_anti").select(*own), failed


def upsert_table(spark: SparkSession, path: str, new: DataFrame, schema: str, keys: Sequence[str] = ("ticker", "date"), date: str = "date", batch: tuple[str, int] | None = None) -> list[str]:
    """Upserts ``new`` into the table at ``path`` and returns the months that it rewrote, of which the table then has a folder each.

    Only the months that ``new`` has rows of are read, shuffled and written; then one manifest publishes all of them, so that a reader sees
    none of the change or all of it. If another writer has published meanwhile, the months that both changed are done again on the other's
    rows. ``batch`` names a stream and its batch: one that is in already changes nothing. A table that isn't in months is cut into months
    by its first upsert.
    """
    if date not in keys:
        raise ValueError(f"{date} is not among the keys: a row could move to another month")
    month = F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(versions.NO_MONTH)).alias("month")
    landed = durable(new.select(*new.columns, month), "landed")
    touched = sorted(r.month for r in landed.select("month").distinct().collect())  # a calendar's months
    written: dict[str, str] = {}
    seen: versions.Version | None = None
    while True:
        base = versions.latest(spark, path)
        if batch and base.batches.get(batch[0], -1) >= batch[1]:
            break
        whole = versions.WHOLE in base.parts
        changed = [m for m in touched if seen is None or base.parts.get(m) != seen.parts.get(m)]
        if whole or changed:
            before = read_table(spark, path, schema) if whole else _months(spark, path, schema, base, changed)
            rows = upsert(before.select("*", month), landed if whole else landed.where(F.col("month").isin(changed)), keys)
            change = f"v-{uuid.uuid4().hex}"
            # partitions of a month or of a part of it, as large as Spark wants them
            rows.hint("rebalance", "month").sortWithinPartitions("month", *keys).write.partitionBy("month").parquet(f"{path}/{change}")
            written = (written if not whole else {}) | {m: f"{change}/month={m}" for m in (_written_months(spark, f"{path}/{change}") if whole else changed)}
        seen = base
        try:
            kept = {} if whole else base.parts
            versions.publish(spark, path, base, kept | written, base.batches | ({batch[0]: batch[1]} if batch else {}))
            break
        except versions.Conflict:
            continue
    remove(spark, *{f.rsplit("/", 1)[0] for f in landed.inputFiles()})
    return sorted(written)


def _months(spark: SparkSession, path: str, schema: str, version: versions.Version, months: Sequence[str]) -> DataFrame:
    found = [f"{path}/{version.parts[m]}" for m in months if m in version.parts]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def _written_months(spark: SparkSession, folder: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    names = [f.getPath().getName() for f in place.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(place)]
    return [n.removeprefix("month=") for n in names if n.startswith("month=")]


def update_table(spark: SparkSession, path: str, landed: DataFrame, schema: str) -> DataFrame:
    """``update_all`` on the table at ``path``: upserts the securities without a failure, month by month, and returns the failed ones."""
    good, failed = split_failures(spark.createDataFrame([], schema), landed)
    failed = durable(failed, "failed")
    upsert_table(spark, path, good, schema)
    return failed


def write_bars(df: DataFrame, path: str, key: str = "ticker", date: str = "date", files: int | None = None) -> bool:
    """Replaces the table at ``path``, sorted within files by key and date so that scans skip row groups. Nothing changes if ``df`` is empty.

    The rows go to a folder of their own, which one manifest then makes the table: a reader sees the old table or the new one whole, and a
    job that fails changes nothing. So ``df`` may read ``path`` itself; ``versions.Conflict`` if another writer changed it meanwhile.
    """
    spark = df.sparkSession
    base, version = versions.latest(spark, path), f"v-{uuid.uuid4().hex}"
    dealt = df.repartitionByRange(files, key, date) if files else df.repartitionByRange(key, date)
    dealt.sortWithinPartitions(key, date).write.parquet(f"{path}/{version}")
    if spark.read.schema(df.schema).parquet(f"{path}/{version}").isEmpty():
        remove(spark, f"{path}/{version}")
        return False
    versions.publish(spark, path, base, {versions.WHOLE: version}, base.batches)
    return True


def write_csv(df: DataFrame, path: str) -> None:
    """The combined table as CSV with a header, its date included."""
    df.write.mode("overwrite").csv(path, header=True)


def list_tickers(bars: DataFrame, renames: DataFrame) -> DataFrame:
    """Stored tickers without old names of renamed ones."""
    return bars.select("ticker").distinct().join(renames.select(F.col("old").alias("ticker")), "ticker", "left_anti").orderBy("ticker")


def price_column(df: DataFrame, *names: str) -> str:
    """The first of ``names`` that the table has: the choice is made for the whole table, not by row."""
    for n in names:
        if n in df.columns:
            return n
    raise ValueError(f"none of {names} is a column")


def refresh(stored: DataFrame, landed: DataFrame, splits: DataFrame, dividends: DataFrame, shares: DataFrame, *, rebuild: bool = False, adj_close: bool = True, cap: bool = True) -> DataFrame:
    """The refresh job as one plan: upsert (or, to ``rebuild``, the landed rows alone), then adjusted closes, then market caps."""
    from ..operators.corporate_actions import adjusted_close, market_cap

    out = landed if rebuild else upsert(stored, landed)
    out = adjusted_close(out, dividends, splits) if adj_close else out
    return market_cap(out, shares, splits) if cap else out
