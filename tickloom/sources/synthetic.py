"""Market tables derived from the TPC-H-like test tables, so that every operator has data that grows with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", F.to_date("l_shipdate").alias("date"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("double").alias("quantity"))


def _bars(lines: DataFrame, *keys: str) -> DataFrame:
    value = F.sum(F.col("price").cast("decimal(18,2)")).cast("double")
    each = F.col("price") / F.col("quantity")
    out = lines.groupBy(*keys).agg(value.alias("value_rub"), F.sum("quantity").alias("volume"), F.min(each).alias("low"), F.max(each).alias("high"))
    close = F.col("value_rub") / F.col("volume")
    return out.withColumns({"close": close, "waprice": close})


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: one security for each brand."""
    brands = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("ticker"))
    return _bars(_lines(spark, sf_dir).join(brands, "l_partkey"), "ticker", "date")


def index_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index: all brands together; its volume is the turnover."""
    return _bars(_lines(spark, sf_dir), "date").select(F.lit("INDEX").alias("ticker"), "date", "close", F.col("value_rub").alias("volume"))


def multi_board_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("ticker"))
    return _bars(_lines(spark, sf_dir).join(brands, "l_partkey"), "ticker", "date", "l_returnflag").withColumnRenamed("l_returnflag", "boardid")


def bond_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).groupBy(F.concat(F.lit("B"), F.col("l_partkey")).alias("secid"), F.col("date").alias("tradedate")).agg(F.sum("quantity").alias("q"))
    return lines.select("secid", "tradedate", (60 + F.col("q") % 80).alias("close"))


def bond_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return read(spark, sf_dir, "part").select(
        F.concat(F.lit("B"), F.col("p_partkey")).alias("secid"), F.lit(1000.0).alias("facevalue"), (size % 13).cast("double").alias("couponpercent"),
        F.when(size % 10 != 0, F.add_months(F.lit("1998-01-01").cast("date"), (size * 2).cast("int"))).alias("matdate"),
    )


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ticker, n``: the brands and their numbers."""
    return read(spark, sf_dir, "part").select(F.col("p_brand").alias("ticker")).distinct().withColumn("n", F.regexp_extract("ticker", r"(\d+)", 1).cast("int"))


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tickers(spark, sf_dir).where("n not in (24, 25)").select("ticker", F.concat(F.lit("S"), F.col("n") % 5).alias("sector"))


def dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = F.explode(F.sequence(F.lit(1996), F.lit(2001)))
    return tickers(spark, sf_dir).select("ticker", "n", years.alias("y")).select("ticker", F.make_date("y", F.lit(6), 1 + F.col("n") % 20).alias("closing_date"), (500 + 10 * F.col("n")).cast("double").alias("dividend_value"))


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots on the first day of each quarter from 1995 to 2001."""
    q = F.explode(F.sequence(F.lit(0), F.lit(27)))
    return tickers(spark, sf_dir).where("n <> 25").select("ticker", "n", q.alias("q")).select("ticker", F.make_date(1995 + F.floor(F.col("q") / 4).cast("int"), (1 + 3 * (F.col("q") % 4)).cast("int"), F.lit(1)).alias("date"), (1000 * F.col("n") + 10 * F.col("q")).cast("double").alias("shares"))


#: Registries. Small fixed tables, as on an exchange.
SPLITS = "(VALUES ('Brand#11', DATE '1998-04-06', 10.0, 'price'), ('Brand#12', DATE '1999-01-20', 0.01, 'auto'), ('Brand#13', DATE '1997-06-02', 100.0, 'shares'), ('Brand#15', DATE '2000-03-01', 4.0, 'auto'))"
SPLITS_JSON = '{"Brand#11": [{"date": "1998-03-10", "ratio": 10, "kind": "split"}], "Brand#14": [{"date": "2000-07-15", "ratio": 5000, "kind": "reverse"}]}'
RENAMES = "(VALUES ('Brand#21', 'Brand#22', DATE '1998-01-02'), ('Brand#22', 'Brand#23', DATE '2000-01-03'))"
KEY_RATE = "(VALUES (DATE '1996-03-01', 12.0), (DATE '1997-02-15', 9.0), (DATE '1998-05-20', 24.0), (DATE '1999-09-01', 15.0), (DATE '2000-11-10', 8.5))"


def splits(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT ticker, date, CAST(ratio AS DOUBLE) AS ratio, kind FROM {SPLITS} AS t(ticker, date, ratio, kind)")


def renames(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT * FROM {RENAMES} AS t(old, new, date)")


def key_rate(spark: SparkSession) -> DataFrame:
    return spark.sql(f"SELECT date, CAST(rate AS DOUBLE) AS rate FROM {KEY_RATE} AS t(date, rate)")


def split_json(spark: SparkSession) -> DataFrame:
    """The nested registry, one document in one row, beside which it is read."""
    return spark.sql(f"SELECT '{SPLITS_JSON}' AS payload")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events")
