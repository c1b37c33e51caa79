"""Trades of a growing folder, appended to a table: each file once, each trade once within the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def arriving(spark: SparkSession, path: str, schema: str, delay: str = "2 days", keys: tuple[str, ...] = ("symbol", "trade_id"), time: str = "time", most_files: int = 1000) -> DataFrame:
    """A stream of the Parquet files under ``path``. A trade that comes again within ``delay`` of the newest goes; trades later than that go too.

    State is the keys of ``delay``, not of the whole history.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(path)
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def append(trades: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived and stop. The checkpoint (in a shared folder) says where the next run goes on."""
    return trades.writeStream.format("parquet").outputMode("append").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
