"""Bars as SQL table functions: ``SELECT * FROM standard_bars(TABLE(t) PARTITION BY symbol ORDER BY (ms, trade_id), 100000.0)``.

The table has ``symbol, ms, price, net, side, qty``; kernels are those of the DataFrame operators.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf

from ..ship import ship
from . import kernels
from .bars import KERNELS

PIECE = 4096


class _Bars:
    def start(self, kernel) -> None:
        self.kernel, self.rows, self.symbol = kernel, [], None

    def add(self, row: Row):
        if self.kernel is None:
            raise RuntimeError("no kernel")
        self.symbol = row["symbol"]
        self.rows.append((row["price"], row["ms"], row["net"], row["side"], row["qty"]))
        return self.flush() if len(self.rows) >= PIECE else []

    def flush(self) -> list[tuple]:
        if not self.rows:
            return []
        price, ms, net, side, qty = (np.array(c) for c in zip(*self.rows, strict=True))
        self.rows = []
        return [(self.symbol, *r) for r in self.kernel.step(price.astype(float), ms, net.astype(float), side, qty.astype(float))]


def table_function(kernel: type[kernels.Kernel]) -> type:
    """A table function of a kernel; its arguments after the table are the kernel's parameters, in their order."""

    class Bars(_Bars):
        def __init__(self):
            self.start(None)

        def eval(self, row: Row, *params: float):
            if self.kernel is None:
                self.kernel = kernel(*[float(p) for p in params])
            yield from self.add(row)

        def terminate(self):
            yield from self.flush()

    return Bars


def register(spark: SparkSession) -> None:
    """``<kind>_bars`` for every kind of bars."""
    ship(spark)
    for kind, (kernel, fields) in KERNELS.items():
        spark.udtf.register(f"{kind}_bars", udtf(table_function(kernel), returnType=f"symbol string, {fields}"))
