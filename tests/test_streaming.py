"""Streams give what batches give."""

from pyspark.sql import functions as F

from tickloom.sources import synthetic as sy
from tickloom.sources.market import read_bars, resample_candles, upsert, upsert_table
from tickloom.streaming.market import stream_candles, stream_upsert

SF = "/root/testdata/sf0.001"


def test_candles_stream_equals_batch(spark, tmp_path):
    trades = sy.events(spark, SF).select("user_id", F.col("ts").cast("timestamp").alias("ts"), "value", "event_id")
    landed = str(tmp_path / "in")
    # a last row far ahead moves the watermark past all others
    late = trades.limit(1).withColumn("ts", F.expr("timestamp'2100-01-01'")).withColumn("user_id", F.lit(-1).cast("long"))
    trades.coalesce(1).write.parquet(landed)
    late.coalesce(1).write.mode("append").parquet(landed)
    stream = spark.readStream.schema(trades.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    q = stream_candles(stream, late="3650 days", key="user_id", price="value", order="event_id").writeStream.format("memory").queryName("candles").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("candles").where("user_id >= 0")
    want = resample_candles(trades, 10, key="user_id", price="value", order="event_id")
    key = lambda r: tuple(r)
    cols = ["user_id", "begin", "open", "high", "low", "close", "n"]
    assert sorted(map(key, got.select(cols).collect())) == sorted(map(key, want.select(cols).collect()))


def test_streamed_upserts_keep_the_correction(spark, tmp_path):
    schema = "ticker string, date date, close double"
    landed, out = str(tmp_path / "in"), str(tmp_path / "out")
    first = spark.sql("select 'A' ticker, date'2024-01-01' + cast(id as int) date, cast(id as double) close from range(4)")
    fix = spark.sql("select 'A' ticker, date'2024-01-03' date, 999.0d close union all select 'A', date'2024-01-06', 5.0d")
    for i, df in enumerate((first, fix)):
        df.coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        stream_upsert(stream, out, str(tmp_path / "cp"), schema).awaitTermination()
        assert read_bars(spark, out, schema=schema).count() == (4, 5)[i]
    rows = {str(r.date): r.close for r in read_bars(spark, out, schema=schema).collect()}
    assert rows["2024-01-03"] == 999.0
    assert len(upsert(first, fix).collect()) == 5


def test_a_batch_that_runs_again_is_in_once(spark, tmp_path):
    schema, out = "ticker string, date date, close double", str(tmp_path / "out")
    bars = lambda day, x: spark.sql(f"select 'A' ticker, date'{day}' date, {x}d close")
    assert upsert_table(spark, out, bars("2024-01-01", 1), schema, batch=("s", 0)) == ["2024-01"]
    upsert_table(spark, out, bars("2024-02-01", 2), schema, batch=("s", 1))
    assert upsert_table(spark, out, bars("2024-01-01", 99), schema, batch=("s", 1)) == []
    assert upsert_table(spark, out, bars("2024-01-02", 3), schema, batch=("other", 0)) == ["2024-01"]
    assert sorted(r.close for r in read_bars(spark, out, schema=schema).collect()) == [1, 2, 3]
