"""Structured Streaming counterparts, an extra: intraday bars from an event stream, with late rows up to a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hourly_bars(events: DataFrame, *, lateness: str = "2 hours", width: str = "1 hour") -> DataFrame:
    """Per user group and hour: open, high, low, close, volume, trades of a stream with ts, user_id, event_id, value."""
    v = F.abs("value") + 1
    order = F.struct("ts", "event_id")
    bars = events.filter(F.col("value").isNotNull()).withWatermark("ts", lateness).groupBy(F.window("ts", width), (F.col("user_id") % 10).cast("int").alias("tk"))
    out = bars.agg(F.min_by(v, order).alias("open"), F.max(v).alias("high"), F.min(v).alias("low"), F.max_by(v, order).alias("close"), F.sum(v).alias("volume"), F.count("*").alias("trades"))
    return out.select(F.col("window.start").alias("start"), "tk", "open", "high", "low", "close", "volume", "trades")


def upsert_batches(stream: DataFrame, path: str, date: str, checkpoint: str):
    """Writes every micro-batch by replacing its date partitions; running a batch again gives the same files."""

    def write(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date).parquet(path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
