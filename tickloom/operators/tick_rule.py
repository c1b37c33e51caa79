"""Sides of trades by the tick rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ORDER = ("ms", "trade_id")
DAY_MS = 86_400_000


def day(ms: str = "ms") -> Column:
    """The day of an epoch in milliseconds, as a ``block`` of ``with_side``."""
    return F.floor(F.col(ms) / DAY_MS)


def raw_side(price: Column, before: Column, convention: str = "reference") -> Column:
    """+1, -1 or null (no change, or no trade before).

    "reference": a falling price is +1, as the data this engine replaces has it. "standard": a rising price is.
    """
    fell, rose = (1, -1) if convention == "reference" else (-1, 1)
    return F.when(before > price, fell).when(before < price, rose)


def with_side(trades: DataFrame, keys: tuple[str, ...] = ("symbol",), order: tuple[str, ...] = ORDER, convention: str = "reference", reset_key: str | None = None, block: Column | None = None) -> DataFrame:
    """``trades`` with ``side`` (1 where nothing is known yet) and ``net``, the signed quote quantity.

    ``reset_key`` starts the rule afresh for each of its values, such as a file or chunk.

    ``block`` never falls along ``order`` (such as ``day()``): blocks of one key are then signed in parallel, with the
    same result. What a block hands to the next, its last price and side, is one row per block. That costs a second
    read and shuffle of the keys, order and price; both shuffles deal by key and block. Without it, one task signs all
    trades of a key.
    """
    part = [*keys, *([reset_key] if reset_key else [])]
    if block is None:
        df = _changes(trades, part, order, convention).withColumn("side", F.coalesce("_change", F.lit(1)).cast("tinyint"))
    else:
        # One struct, as null keys are equal inside it, in windows and in joins alike.
        df = _changes(trades.withColumn("_part", F.struct(*part, block.alias("_block"))), ["_part"], order, convention)
        df = df.join(_before(df, order, convention), "_part").withColumn("side", F.coalesce("_change", "_before", F.lit(1)).cast("tinyint"))
    return df.drop("_change", "_part", "_before").withColumn("net", F.col("quote_qty") * F.col("side"))


def _changes(trades: DataFrame, part: list[str], order: tuple[str, ...], convention: str) -> DataFrame:
    """``trades`` with the side of the last change of price in their part, ``_change``; null before the first."""
    w = Window.partitionBy(*part).orderBy(*order)
    df = trades.withColumn("_raw", raw_side(F.col("price"), F.lag("price").over(w), convention))
    return df.withColumn("_change", F.last("_raw", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).drop("_raw")


def _before(changes: DataFrame, order: tuple[str, ...], convention: str) -> DataFrame:
    """``_part, _before``: the side that holds from a block's first trade on, up to its own first change."""
    at = F.struct(*order)
    ends = changes.groupBy("_part").agg(F.min_by("price", at).alias("first"), F.max_by("price", at).alias("last"), F.max_by("_change", at).alias("change"))
    own = [c for c in changes.schema["_part"].dataType.names if c != "_block"]
    w = Window.partitionBy(*[F.col("_part")[c] for c in own]).orderBy(F.col("_part")["_block"])
    ends = ends.withColumn("turn", raw_side(F.col("first"), F.lag("last").over(w), convention))
    until = F.last(F.coalesce("change", "turn"), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return ends.select("_part", F.coalesce("turn", until).alias("_before"))
