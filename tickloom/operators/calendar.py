"""Calendars and their gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F


def days(spark: SparkSession, first: str, last: str, step: str = "1 day") -> DataFrame:
    """``day`` from first to last, both included; ``step`` may be months."""
    return spark.sql(f"SELECT explode(sequence(DATE '{first}', DATE '{last}', INTERVAL {step})) AS day")


def distinct_days(df: DataFrame, time: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*keys, F.to_date(time).alias("day")).distinct()


def expand(df: DataFrame, first: str, last: str, step: str = "1 day", name: str = "day", keys: tuple[str, ...] = ()) -> DataFrame:
    """Each day (or month) of every range once."""
    start = F.trunc(first, "MM") if "month" in step else F.to_date(first)
    return df.select(*keys, F.explode(F.sequence(start, F.to_date(last), F.expr(f"INTERVAL {step}"))).alias(name)).distinct()


def missing(expected: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    """What the calendar has and the data lack."""
    return expected.join(found, on, "left_anti")


def daily_gaps(found: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Days between consecutive days of the data (columns ``day`` and keys)."""
    w = Window.partitionBy(*keys).orderBy("day")
    nxt = found.withColumn("next_day", F.lead("day").over(w)).where(F.datediff("next_day", "day") > 1)
    return nxt.select(*keys, F.explode(F.sequence(F.date_add("day", 1), F.date_sub("next_day", 1))).alias("missing_day"))


def month_gaps(df: DataFrame, time: str, keys: tuple[str, ...]) -> DataFrame:
    """Per key and month: first and last day, and the days missing before and after."""
    d = df.select(*keys, F.to_date(time).alias("day"))
    g = d.groupBy(*keys, F.trunc("day", "MM").alias("month")).agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    return g.select("*", (F.datediff("last_day", "first_day") + 1).alias("days_covered"), F.datediff("first_day", "month").alias("missing_head"), F.datediff(F.last_day("month"), "last_day").alias("missing_tail"))


def since(df: DataFrame, time: str, year: int = 2017) -> DataFrame:
    """Rows of ``year`` and later; earlier ones are corrupted times."""
    return df.where(F.year(time) >= year)


def before(df: DataFrame, day: str, today: Column | None = None) -> DataFrame:
    """Days that are over: all before ``today`` (default: the session's current date)."""
    return df.where(F.col(day) < (F.current_date() if today is None else today))


def other_period(named: str, first: str, unit: str = "DD") -> Column:
    """Whether a file's named period (day DD or month MM) isn't that of its first row."""
    if unit == "DD":
        return F.to_date(named) != F.to_date(first)
    return F.trunc(named, unit) != F.trunc(first, unit)


def is_weekend(day: Column) -> Column:
    return F.weekday(day).isin(5, 6)


def complete(existing: Column, absent: Column) -> Column:
    """Percent of what should be there."""
    return F.when(existing + absent > 0, 100.0 * existing / (existing + absent)).otherwise(0.0)
