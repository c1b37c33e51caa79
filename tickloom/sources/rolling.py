"""Compaction into numbered parts of bounded size, file after file in the order of their names."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..ship import ship
from .inventory import listing, write_trades

#: A part takes files up to this share of its bound, and a file is expected to shrink to RATIO of its size.
FILL, RATIO = 0.95, 0.9
#: Bytes of a task when a part is written.
TASK = 256 << 20


def numbered(files: DataFrame, max_bytes: int, keys: tuple[str, ...] = ("symbol",), number: int = 0, held: float | None = None) -> DataFrame:
    """``files`` (keys, name, bytes) with ``number``, the part that takes each.

    Files go in the order of their names; one that would lift a part above its bound opens the next one, and a part has
    one file at least. The first part is ``number``, or the one with that number that holds ``held`` bytes already.
    Only the inventory is read: a row per file, in sorted batches, one open part per key in memory.
    """
    ship(files.sparkSession)
    own = files.select(*keys, "name", F.col("bytes").cast("long").alias("bytes"))
    out = own.withColumn("number", F.lit(0).cast("long"))
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, part, size, opened = None, number, 0.0, False
        for batch in batches:
            numbers = []
            ids = zip(*[batch.column(k).to_pylist() for k in keys], strict=True) if keys else [()] * batch.num_rows
            for key, b in zip(ids, batch.column("bytes").to_pylist(), strict=True):
                if key != now:
                    now, part, size, opened = key, number, held or 0.0, held is not None
                add = RATIO * (b or 0)
                if opened and size + add > FILL * max_bytes:
                    part, size = part + 1, 0.0
                size, opened = size + add, True
                numbers.append(part)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], schema=arrow)

    dealt = own.repartition(*keys) if keys else own.coalesce(1)
    return dealt.sortWithinPartitions(*keys, "name").mapInArrow(run, out.schema)


def parts(spark: SparkSession, target: str) -> DataFrame:
    """``number, bytes, files`` of what has been written."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(target)
    return found.groupBy(F.regexp_extract("path", r"/number=(\d+)/", 1).cast("long").alias("number")).agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))


def compact_rolling(spark: SparkSession, source: str, target: str, max_bytes: int = 10 << 30, codec: str = "snappy", update: bool = False) -> int:
    """Write the trades of ``source``'s files to ``target/number=N``, sorted by time within a part; the source stays.

    ``update``: ``target`` has parts; the files go on in its last one while that has room. Returns the rows of the target,
    which are counted again after writing. Spark names the files of a part: a part is a folder, so that its tasks run
    in parallel and a lost executor costs one file.
    """
    last = parts(spark, target).orderBy(F.desc("number")).first() if update else None
    files = listing(spark, source, "*.parquet").select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"))
    plan = numbered(files, max_bytes, (), last["number"] if last else 1, float(last["bytes"]) if last else None)
    size = files.agg(F.sum("bytes")).first()[0] or 0
    trades = spark.read.parquet(source).withColumn("_name", F.col("_metadata.file_name"))
    trades = trades.join(plan.select(F.col("name").alias("_name"), "number"), "_name").drop("_name")
    dealt = trades.repartitionByRange(max(1, -(-size // TASK)), "number", "time", "trade_id").sortWithinPartitions("number", "time", "trade_id")
    return write_trades(dealt, target, codec, "append" if update else "overwrite", by=["number"])


def newest(spark: SparkSession, target: str) -> DataFrame:
    """The last part's rows."""
    df = spark.read.parquet(target)
    top = F.broadcast(df.agg(F.max("number").alias("_top")))  # one row
    return df.join(top, df["number"] == top["_top"]).drop("_top")
