"""Footers of Parquet files: rows, row groups, codec and time bounds without a scan."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from ..ship import ship
from .inventory import listing

FIELDS = "path string, bytes bigint, n_rows bigint, n_row_groups bigint, codec string, low timestamp, high timestamp"


def _opened(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), path.removeprefix("file:").replace("//", "", 1) if path.startswith("file://") else path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path)


def _utc(t: datetime) -> datetime:
    return t.replace(tzinfo=UTC) if t.tzinfo is None else t


def _bounds(meta: pq.FileMetaData, column: str) -> tuple[datetime | None, datetime | None]:
    """Least and greatest value by the statistics; nothing if a row group with rows has none, or they aren't times."""
    at = next((i for i in range(meta.num_columns) if meta.schema.column(i).path == column), None)
    if at is None:
        return None, None
    lows, highs = [], []
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        stats = group.column(at).statistics
        if stats is None or (not stats.has_min_max and stats.null_count != group.num_rows):
            return None, None
        if stats.has_min_max:
            lows.append(stats.min)
            highs.append(stats.max)
    if not lows or not isinstance(lows[0], datetime):
        return None, None
    return _utc(min(lows)), _utc(max(highs))


def footers(spark: SparkSession, path: str, time: str = "time", pattern: str = "*.parquet") -> DataFrame:
    """A row per file (FIELDS), read from footers alone; ``low`` and ``high`` are the bounds of column ``time``.

    Bounds are null where a file has no such column, no rows or no statistics. Codecs of several kinds are joined by a
    comma. Spark writes statistics of times only where ``spark.sql.parquet.outputTimestampType`` isn't INT96. Files are listed by Spark and opened by pyarrow, which must know their file system.
    """
    ship(spark)
    time_type = pa.timestamp("us", tz="UTC")
    arrow = pa.schema([("path", pa.string()), *[(c, pa.int64()) for c in ("bytes", "n_rows", "n_row_groups")], ("codec", pa.string()), ("low", time_type), ("high", time_type)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                fs, inner = _opened(p)
                with fs.open_input_file(inner) as f:
                    meta = pq.read_metadata(f)
                groups = [meta.row_group(g) for g in range(meta.num_row_groups)]
                codecs = sorted({g.column(c).compression for g in groups for c in range(g.num_columns)})
                rows.append((p, length, meta.num_rows, meta.num_row_groups, ",".join(codecs).lower(), *_bounds(meta, time)))
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return listing(spark, path, pattern).select("path", "length").mapInArrow(run, FIELDS)
