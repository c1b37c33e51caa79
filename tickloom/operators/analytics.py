"""Statistics of bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def describe(df: DataFrame, columns: list[str], keys: tuple[str, ...] = ()) -> DataFrame:
    """A row per column (and key): count, mean, std, min, quartiles (exact, interpolated), max."""
    long = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns])).alias("s")).select(*keys, "s.*")
    g = long.groupBy(*keys, "column").agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"), F.min("x").alias("low"), F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("q"), F.max("x").alias("high"))
    return g.select(*keys, "column", "n", "mean", "std", "low", F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "high")


def gaps(bars: DataFrame, keys: tuple[str, ...] = ("symbol",)) -> DataFrame:
    """Minutes between the ends of consecutive bars."""
    w = Window.partitionBy(*keys).orderBy("bar_id")
    return bars.select(*keys, "bar_id", ((F.col("end_time") - F.lag("end_time").over(w)) / 60_000.0).alias("gap_minutes")).where("gap_minutes is not null")


def balance(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """``name, score``: the mean of each column over its least value; the least score is the best balance."""
    low = F.broadcast(df.agg(*[F.min(c).alias(f"_{c}") for c in columns]))  # one row
    total = sum(F.col(c) / F.col(f"_{c}") for c in columns)
    return df.join(low).select(name, *columns, (total / len(columns)).alias("score"))


def iteration_means(runs: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Means of repeated measurements, with their number."""
    return runs.groupBy(*keys).agg(F.count("*").alias("iterations"), *[F.avg(F.col(m).cast("double")).alias(m) for m in measures])
