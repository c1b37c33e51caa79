"""Views of trades over other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trades: ``symbol, trade_id, ms, price, qty, quote_qty, is_buyer_maker``; ms is milliseconds since 1970."""
    e = table(spark, sf_dir, "events")
    qty = (F.get_json_object("props", "$.k").cast("int") + 1).cast("double")
    return e.select(F.col("event_type").alias("symbol"), F.col("event_id").alias("trade_id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"), F.col("value").alias("price"), qty.alias("qty"), (F.col("value") * qty).alias("quote_qty"), (F.col("user_id") % 2 == 0).alias("is_buyer_maker"))


def trades_ord(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as trades; many share their time, so the trade id decides."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderpriority").alias("symbol"), F.col("o_orderkey").alias("trade_id"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ms"), F.col("o_totalprice").alias("price"), F.lit(1.0).alias("qty"), F.col("o_totalprice").alias("quote_qty"))
