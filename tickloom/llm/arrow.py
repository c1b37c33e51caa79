"""Small helpers for operators that work on Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..ship import ship

#: Text bytes that one Arrow slice may hold before it is cut into smaller ones.
SLICE_BYTES = 4 << 20


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text`` alone: other columns, whatever their names, can't clash, and the scan reads two columns."""
    return docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def slices(batch: pa.RecordBatch, column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text, one row at least."""
    mean = max(1, batch.column(column).nbytes // max(1, batch.num_rows))
    step = max(1, size // mean)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def map_texts(rows: DataFrame, schema: StructType | str, make: Callable[[], Callable[[list, list[str]], Sequence[Any]]], size: int = SLICE_BYTES) -> DataFrame:
    """Apply ``make()(ids, texts)`` to every slice (of about ``size`` bytes) of ``rows`` (id, text); it returns the columns after ``id``.

    ``make`` runs once in each Python worker task, so models load there and nowhere else.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    ship(rows.sparkSession)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            for part in slices(batch, size=size):
                work = work or make()
                ids = part.column("id")
                columns = work(ids.to_pylist(), part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:], strict=True))], schema=arrow)

    return rows.mapInArrow(run, schema)


def keep_texts(docs: DataFrame, make: Callable[[], Callable[[list[str]], Sequence[bool]]], text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text (null: empty) ``make()(texts)`` keeps."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            for part in slices(batch, text_col):
                work = work or make()
                yield part.filter(pa.array(work([t or "" for t in part.column(text_col).to_pylist()]), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
