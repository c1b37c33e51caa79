"""Files, ledgers, synthetic trades, and Parquet sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

CODECS = ("snappy", "zstd", "lz4", "gzip", "none")


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """A row per file: rows, size and time bounds if it has ``time``."""
    df = spark.read.parquet(path)
    bounds = [F.min("time").alias("first_time"), F.max("time").alias("last_time")] if "time" in df.columns else []
    return df.groupBy(F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"), *bounds)


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    b = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return b.select("path", "length", "modificationTime")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """A JSON ledger of date lists as ``date, status``."""
    names = ("downloaded", "processed", "failed", "processing_failed", "extracted", "verified")
    schema = ", ".join(f"{n} array<string>" for n in names)
    df = spark.read.schema(schema).json(path, multiLine=True)
    lists = F.array(*[F.struct(F.lit(n).alias("status"), F.coalesce(F.col(n), F.array()).alias("dates")) for n in names])
    return df.select(F.explode(lists).alias("s")).select(F.explode("s.dates").alias("date"), F.col("s.status").alias("status"))


def write_ledger(entries: DataFrame, path: str) -> None:
    entries.groupBy("status").agg(F.array_sort(F.collect_set("date")).alias("dates")).write.mode("overwrite").json(path)


def synthetic_trades(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """Trades every 100 ms from 2024 on: uniform prices, exponential quantities, random flags."""
    t0 = 1_704_067_200_000
    exp = lambda scale, k: -F.log(1 - F.rand(seed + k)) * scale
    return spark.range(n).select(
        (F.col("id") + 1).alias("trade_id"), (30_000 + 10_000 * F.rand(seed)).alias("price"), exp(0.1, 1).alias("qty"), exp(1000.0, 2).alias("quoteQty"), F.timestamp_millis(F.lit(t0) + F.col("id") * 100).alias("time"),
        (F.rand(seed + 3) < 0.5).alias("isBuyerMaker"), (F.rand(seed + 4) < 0.9).alias("isBestMatch"),
    )


def write_trades(trades: DataFrame, path: str, codec: str = "snappy", mode: str = "append", partition: bool = False, by: list[str] | None = None) -> int:
    """Write, read the row count back and compare; returns it. ``partition``: by day; ``by``: by these columns."""
    if codec not in CODECS:
        raise ValueError(f"codec {codec}: one of {', '.join(CODECS)}")
    spark = trades.sparkSession
    try:
        before = spark.read.parquet(path).count() if mode == "append" else 0
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        before = 0
    from pyspark.sql import Observation

    seen = Observation()
    out = trades.observe(seen, F.count(F.lit(1)).alias("n"))
    if partition:
        out = out.withColumn("date", F.to_date("time"))
    writer = out.write.mode(mode).option("compression", codec)
    folders = (by or []) + (["date"] if partition else [])
    (writer.partitionBy(*folders) if folders else writer).parquet(path)
    now = spark.read.parquet(path).count()
    if now - before != seen.get["n"]:
        raise RuntimeError(f"{path}: wrote {seen.get['n']} rows, found {now - before}")
    return now


def head(df: DataFrame, n: int, order: tuple[str, ...]) -> DataFrame:
    """The first ``n`` rows in a total order; each task keeps ``n`` at most."""
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, order: tuple[str, ...]) -> DataFrame:
    """The last ``n`` rows in a total order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n)


def write_failed(entries: DataFrame, path: str) -> None:
    """The dates of a ledger that failed, one per line, in order."""
    failed = entries.where(F.col("status").isin("failed", "processing_failed")).select(F.col("date").alias("value")).distinct()
    failed.orderBy("value").coalesce(1).write.mode("overwrite").text(path)


def write_bars(bars: DataFrame, folder: str, kind: str, stamp: str, codec: str = "snappy", **tags: str) -> str:
    """Bars of one run in a folder of their own, named by kind and time; tags become columns. Returns its path."""
    for k, v in tags.items():
        bars = bars.withColumn(k, F.lit(v))
    path = f"{folder.rstrip('/')}/{kind}_{stamp}"
    write_trades(bars, path, codec, "error")
    return path


def read_bars(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """The bars of all runs of a kind, with ``run``, the folder that they are from."""
    df = spark.read.option("mergeSchema", True).parquet(f"{folder.rstrip('/')}/{kind}_*")
    return df.withColumn("run", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2))


def compact(spark: SparkSession, source: str, target: str, max_bytes: int = 10 << 30, codec: str = "snappy", ratio: float = 0.9) -> int:
    """Rewrite many files as few, in order of time, each of about ``max_bytes``; the source stays. Returns the rows."""
    total = listing(spark, source, "*.parquet").agg(F.sum("length")).first()[0] or 0
    n = max(1, -(-int(total * ratio) // int(max_bytes * 0.95)))
    df = spark.read.parquet(source)
    dealt = df.repartitionByRange(n, "time", "trade_id").sortWithinPartitions("time", "trade_id")
    return write_trades(dealt, target, codec, "overwrite")


def append_jdbc(bars: DataFrame, url: str, table: str = "dollar_bars", **tags: str) -> None:
    """Append bars with their tags to a database; its driver must be on the class path."""
    for k, v in tags.items():
        bars = bars.withColumn(k, F.lit(v))
    bars.write.jdbc(url, table, mode="append")
