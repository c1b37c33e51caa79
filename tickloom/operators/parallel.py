"""A function of the user over rows such as files or days, in parallel."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from ..ship import ship


def parallel_map(items: DataFrame, function: Callable[[dict], dict], fields: str, tries: int = 1, wait: float = 0.0, tasks: int | None = None) -> DataFrame:
    """``function`` of every row, as columns ``fields``, with ``error``: null, or the last try's error beside null fields.

    A failing item doesn't fail the others. ``wait`` seconds, doubled each time, pass before another try. ``tasks`` deals
    the items anew where they are few and slow.
    """
    if tries < 1:
        raise ValueError("tries: one at least")
    ship(items.sparkSession)
    out = StructType([*StructType.fromDDL(fields).fields, StructField("error", StringType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def one(item: dict) -> dict:
        pause = wait
        for left in reversed(range(tries)):
            try:
                return {**function(item), "error": None}
            except Exception as e:
                if not left:
                    return {"error": f"{type(e).__name__}: {e}"}
            time.sleep(pause)
            pause *= 2
        raise AssertionError

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                yield pa.RecordBatch.from_pylist([one(r) for r in batch.slice(at, 100).to_pylist()], schema=arrow)

    return (items.repartition(tasks) if tasks else items).mapInArrow(run, out)
