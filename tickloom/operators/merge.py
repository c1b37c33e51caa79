"""Incremental merges, ledgers and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def watermark(existing: DataFrame, time: str = "ms") -> DataFrame:
    """One row: the latest time."""
    return existing.agg(F.max(time).alias("watermark"))


def newer(rows: DataFrame, existing: DataFrame, time: str = "ms", inclusive: bool = False) -> DataFrame:
    """Rows after (or at) the latest time of what exists; all of them if nothing does."""
    mark = F.broadcast(watermark(existing, time))  # one row
    keep = (F.col(time) >= F.col("watermark")) if inclusive else (F.col(time) > F.col("watermark"))
    return rows.join(mark).where(F.col("watermark").isNull() | keep).select(*rows.columns)


def first_by(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in a total order (ascending, nulls first): reproducible, unlike dropDuplicates, and combined before the shuffle."""
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.groupBy(*keys).agg(F.min_by(row, F.struct(*order)).alias("_first")).select("_first.*")


def merge_incremental(existing: DataFrame, rows: DataFrame, keys: list[str], time: str = "ms", order: list[Column | str] | None = None, inclusive: bool = True) -> DataFrame:
    """Existing rows and the new ones at or after their latest time, each key once; existing rows win."""
    fresh = newer(rows, existing, time, inclusive).join(existing.select(*keys).distinct(), keys, "left_anti")
    return existing.unionByName(first_by(fresh, keys, order or [time]))


def within(days: DataFrame, files: DataFrame, day: str = "day", first: str = "first_day", last: str = "last_day") -> DataFrame:
    """Files whose range holds a day. Ranges are spelt out to days, so that it is an equi-join at any size."""
    spelt = files.withColumn(day, F.explode(F.sequence(first, last)))
    return days.join(spelt, day)


def reconcile(ledger: DataFrame, data: DataFrame, on: list[str]) -> DataFrame:
    """Entries of a ledger with ``present``: whether the data have them."""
    there = data.select(*on).distinct().withColumn("_there", F.lit(True))
    return ledger.join(there, on, "left").withColumn("present", F.coalesce("_there", F.lit(False))).drop("_there")


def verify(files: DataFrame, sums: DataFrame, on: str, content: str = "content", checksum: str = "checksum") -> DataFrame:
    """Files without their content, with ``status``: ok, mismatch or unchecked (no checksum). Hashed where they are read: only hashes meet the sums."""
    hashed = files.select(*[c for c in files.columns if c != content], F.sha2(content, 256).alias("actual"))
    both = hashed.join(sums, on, "left")
    expected = F.lower(F.split(F.trim(checksum), r"\s+")[0])
    return both.withColumn("status", F.when(F.col(checksum).isNull(), "unchecked").when(expected == F.col("actual"), "ok").otherwise("mismatch"))


def state(downloaded: Column, extracted: Column, completed: Column) -> Column:
    """What is next for a date."""
    return F.when(completed, "completed").when(extracted, "csv_ready").when(downloaded, "zip_ready").otherwise("not_downloaded")
