"""Candles and upserts on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.market import upsert_table


def stream_candles(trades: DataFrame, width: str = "10 minutes", late: str = "1 hour", key: str = "ticker", ts: str = "ts", price: str = "price", order: str | None = None) -> DataFrame:
    """Tumbling candles of a stream of trades; a candle is final once the watermark, ``late`` behind the newest trade, has passed its end."""
    at = F.struct(ts, order) if order else F.col(ts)
    return (
        trades.withWatermark(ts, late).groupBy(key, F.window(ts, width).alias("_w"))
        .agg(F.min_by(price, at).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), F.max_by(price, at).alias("close"), F.sum(price).alias("value_rub"), F.count(price).alias("n"))
        .select(key, F.col("_w.start").alias("begin"), "open", "high", "low", "close", "value_rub", "n")
    )


def stream_upsert(landed: DataFrame, path: str, checkpoint: str, schema: str, keys: tuple[str, ...] = ("ticker", "date"), date: str = "date") -> StreamingQuery:
    """Upserts each batch of landed bars into the table at ``path``, as ``upsert_table`` does: only the months that a batch touches are read and
    written, and all of them are published at once. A correction of a stored day wins as the newer arrival.

    The manifest that publishes a batch names it, so a batch that runs again after a failure is in once.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        upsert_table(batch.sparkSession, path, batch, schema, keys, date, (checkpoint, batch_id))

    return landed.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
