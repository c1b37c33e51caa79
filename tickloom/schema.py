"""Schemas of trades and bars."""

from __future__ import annotations

from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType, TimestampType

TRADES = StructType(
    [
        StructField("trade_id", LongType()),
        *[StructField(c, DoubleType()) for c in ("price", "qty", "quoteQty")],
        StructField("time", TimestampType()),
        *[StructField(c, BooleanType()) for c in ("isBuyerMaker", "isBestMatch")],
    ]
)
#: Column names of the raw files, in order: spot has all, futures lack the last.
SPOT_FIELDS = ("trade_id", "price", "qty", "quoteQty", "time", "isBuyerMaker", "isBestMatch")
FUTURES_FIELDS = SPOT_FIELDS[:-1]
#: Headers that exchanges use, and our names for them.
ALIASES = {"id": "trade_id", "quote_qty": "quoteQty", "is_buyer_maker": "isBuyerMaker", "is_best_match": "isBestMatch"}

_BAR = "bar_id bigint, start_time bigint, end_time bigint, open double, high double, low double, close double"
_SUMS = "total_volume_buy_usd double, total_volume_usd double, total_volume double"
STANDARD_BARS = f"{_BAR}, theta_k double, {_SUMS}, ticks bigint, ticks_buy bigint"
IMBALANCE_BARS = f"{STANDARD_BARS}, ewma_T double, ewma_imbalance double"
VOLUME_IMBALANCE_BARS = f"{_BAR}, imbalance_col double, {_SUMS}"
VOLUME_IMBALANCE_PARAMS = "bar_id bigint, ewma_volume double, ewma_dif double, thres double"
