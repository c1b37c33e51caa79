"""Bars as DataFrames.

One shuffle: the window of the tick rule deals trades by symbol and sorts them, and the kernel reads them in that
order, a batch at a time. Memory is one batch and one open bar, however long a symbol's history. What a bar is depends
on all before it, so symbols (and parameter sets), not parts of a symbol, run in parallel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .. import schema
from ..ship import ship
from . import kernels
from .tick_rule import ORDER, with_side

KERNELS = {
    "standard": (kernels.Standard, schema.STANDARD_BARS),
    "volume": (kernels.Volume, schema.STANDARD_BARS),
    "imbalance": (kernels.Imbalance, schema.IMBALANCE_BARS),
    "tick_imbalance": (kernels.TickImbalance, schema.IMBALANCE_BARS),
    "volume_imbalance": (kernels.VolumeImbalance, schema.VOLUME_IMBALANCE_BARS),
    "run": (kernels.Run, schema.STANDARD_BARS),
}


def _borders(columns: list[pa.Array], n: int) -> list[int]:
    """Rows of a batch where a group begins or the batch ends."""
    changed = np.zeros(max(0, n - 1), bool)
    for c in columns:
        before, after = c.slice(0, n - 1), c.slice(1)
        changed |= pc.fill_null(pc.not_equal(before, after), False).to_numpy(zero_copy_only=False)
        changed |= before.is_null().to_numpy(zero_copy_only=False) != after.is_null().to_numpy(zero_copy_only=False)
    return [0, *(np.flatnonzero(changed) + 1).tolist(), n]


def _over_groups(signed: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], makes: list[Callable[[], kernels.Kernel]], fields: str, emit_partial: bool, trace: bool = False, tag: str | None = None) -> DataFrame:
    """Bars of every group by each of ``makes``, all over the same batches; ``tag`` names the column that tells them apart."""
    ship(signed.sparkSession)
    out = StructType(([StructField(tag, IntegerType())] if tag else []) + [signed.schema[k] for k in keys] + StructType.fromDDL(fields).fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        running: list[kernels.Kernel] = []
        rows: list[tuple] = []

        def add(i: int, found: list[tuple]) -> None:
            head = (i, *now) if tag else now
            rows.extend((*head, *r) for r in found)

        def finish() -> None:
            for i, kernel in enumerate(running):
                add(i, kernel.trace if trace else kernel.partial() if emit_partial else [])

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(arrow)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

        for batch in batches:
            ids = [batch.column(k) for k in keys]
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("price", "ms", "net", "side", "qty")]
            borders = _borders(ids, batch.num_rows) if batch.num_rows else [0]
            for at, stop in zip(borders, borders[1:], strict=False):
                key = tuple(c[at].as_py() for c in ids)
                if key != now:
                    if now is not None:
                        finish()
                    now, running = key, [make() for make in makes]
                for i, kernel in enumerate(running):
                    closed = kernel.step(*[c[at:stop] for c in cols])
                    if not trace:
                        add(i, closed)
            if len(rows) > 10_000:
                yield batch_of()
                rows.clear()
        if now is not None:
            finish()
        if rows:
            yield batch_of()

    needed = signed.select(*keys, *order, *[c for c in ("price", "net", "side", "qty") if c not in order])
    return needed.sortWithinPartitions(*keys, *order).mapInArrow(run, out)


def bars(trades: DataFrame, kind: str, params: dict | None = None, keys: tuple[str, ...] = ("symbol",), order: tuple[str, ...] = ORDER, emit_partial: bool = False, convention: str = "reference", reset_key: str | None = None, float32: bool = False, trace: bool = False) -> DataFrame:
    """Bars of every symbol.

    kind: standard, volume, imbalance, tick_imbalance, volume_imbalance or run, with the parameters of its kernel.
    emit_partial: also the bar that is open at the end. float32: round prices and quantities first, as narrow files do.
    trace: in place of bars, what a volume_imbalance kernel has learnt after each.
    """
    cls, fields = KERNELS[kind]
    if trace:
        fields = schema.VOLUME_IMBALANCE_PARAMS
    if float32:
        trades = trades.withColumns({c: F.col(c).cast("float").cast("double") for c in ("price", "qty", "quote_qty")})
    signed = with_side(trades, keys, order, convention, reset_key)
    if reset_key:  # the rule's window deals by key and chunk, a kernel needs all chunks of its key
        signed = signed.repartition(*keys)
    given = params or {}
    return _over_groups(signed, keys, order, [lambda: cls(**given)], fields, emit_partial, trace)


def bars_sweep(trades: DataFrame, kind: str, grid: list[dict], order: tuple[str, ...] = ORDER, emit_partial: bool = False) -> DataFrame:
    """Bars for each set of parameters, told apart by ``param_id`` (its place in ``grid``); one shuffle and sort serve all of them."""
    cls, fields = KERNELS[kind]
    makes = [lambda given=given: cls(**given) for given in grid]
    return _over_groups(with_side(trades, ("symbol",), order), ("symbol",), order, makes, fields, emit_partial, tag="param_id")


def bars_from_ids(trades: DataFrame, keys: tuple[str, ...] = ("symbol",), bar_col: str = "bar_id", order: tuple[str, ...] = ORDER) -> DataFrame:
    """Bars of trades that know their bar: plain partial aggregates."""
    at = F.struct(*order)
    signed = trades if "net" in trades.columns else with_side(trades, keys, order)
    return signed.groupBy(*keys, bar_col).agg(
        F.min("ms").alias("start_time"), F.max("ms").alias("end_time"), F.min_by("price", at).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", at).alias("close"),
        F.sum("net").alias("theta_k"), F.sum(F.when(F.col("side") > 0, F.col("net")).otherwise(0.0)).alias("total_volume_buy_usd"), F.sum(F.abs("net")).alias("total_volume_usd"), F.sum("qty").alias("total_volume"),
        F.count("*").alias("ticks"), F.count_if(F.col("side") > 0).alias("ticks_buy"),
    )


def tick_bars(trades: DataFrame, ticks: int, keys: tuple[str, ...] = ("symbol",), order: tuple[str, ...] = ORDER) -> DataFrame:
    """Bars of ``ticks`` trades (an extension), the last one as long as it is."""
    w = Window.partitionBy(*keys).orderBy(*order)
    signed = with_side(trades, keys, order).withColumn("bar_id", F.floor((F.row_number().over(w) - 1) / ticks))
    return bars_from_ids(signed, keys, "bar_id", order)
