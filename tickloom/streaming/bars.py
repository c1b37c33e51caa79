"""Bars of a stream of trades: the same kernels, their state kept by Structured Streaming.

Trades of a micro-batch are put in order; one that comes after a later one has been read is dropped, as bars can't be
reopened. The state of a symbol is its kernel, and what the tick rule knows.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState

from ..operators.bars import KERNELS
from ..ship import ship


def stream_bars(trades: DataFrame, kind: str, params: dict | None = None, convention: str = "reference") -> DataFrame:
    """Bars of a streaming DataFrame of ``symbol, trade_id, ms, price, qty, quote_qty``, as they close."""
    ship(trades.sparkSession)
    cls, fields = KERNELS[kind]
    given = params or {}
    up = 1 if convention == "reference" else -1

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        kernel, price, side, last = pickle.loads(state.get[0]) if state.exists else (cls(**given), None, 1, (-1, -1))
        rows = pd.concat(list(frames)).sort_values(["ms", "trade_id"])
        rows = rows[[t > last for t in zip(rows["ms"], rows["trade_id"], strict=True)]]
        out: list[Any] = []
        if len(rows):
            p = rows["price"].to_numpy(float)
            before = np.concatenate([[p[0] if price is None else price], p[:-1]])
            raw = np.where(before > p, up, np.where(before < p, -up, 0))
            known = np.where(raw != 0, np.arange(len(raw)), -1)
            at = np.maximum.accumulate(known)
            sides = np.where(at >= 0, raw[np.maximum(at, 0)], side)
            out = kernel.step(p, rows["ms"].to_numpy(), rows["quote_qty"].to_numpy(float) * sides, sides, rows["qty"].to_numpy(float))
            price, side, last = float(p[-1]), int(sides[-1]), (int(rows["ms"].iloc[-1]), int(rows["trade_id"].iloc[-1]))
        state.update((pickle.dumps((kernel, price, side, last)),))
        names = [f.split()[0] for f in fields.split(", ")]
        yield pd.DataFrame([(key[0], *r) for r in out], columns=["symbol", *names])

    needed = trades.select("symbol", "trade_id", "ms", "price", "qty", "quote_qty")
    return needed.groupBy("symbol").applyInPandasWithState(update, f"symbol string, {fields}", "state binary", "append", "NoTimeout")
