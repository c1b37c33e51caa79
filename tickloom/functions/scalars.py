"""Scalar functions of the ingest: epochs, flags, names, classes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: File names that carry a period, and those of compacted files.
DAILY = r"^([A-Za-z0-9]+)-[Tt]rades-(\d{4})-(\d{2})-(\d{2})\.parquet$"
MONTHLY = r"^([A-Za-z0-9]+)-[Tt]rades-(\d{4})-(\d{2})(?:-\d{2})?\.parquet$"
COMPACTED = r"^([A-Za-z0-9]+)-[Tt]rades-Optimized-(\d+)\.parquet$"


def epoch_ms(t: Column) -> Column:
    """Milliseconds since 1970 of an epoch in seconds, milliseconds or microseconds, told apart by its digits."""
    digits = F.length(t.cast("string"))
    return F.when(digits >= 16, F.floor(t / 1000).cast("long")).when(digits >= 13, t.cast("long")).otherwise(t.cast("long") * 1000)


def flag(text: Column) -> Column:
    """True for any spelling of "true", else false."""
    return F.coalesce(F.lower(F.trim(text)) == "true", F.lit(False))


def flag_of_number(x: Column) -> Column:
    return F.coalesce(x != 0, F.lit(False))


def url_path(symbol: Column, market: Column, granularity: Column, day: Column) -> Column:
    """Path of an archive: ``data/<market>/<granularity>/trades/<SYMBOL>/<SYMBOL>-trades-<period>.zip``."""
    period = F.when(granularity == "monthly", F.date_format(day, "yyyy-MM")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    folder = F.when(market == "spot", F.lit("spot")).otherwise(F.concat(F.lit("futures/"), market))
    return F.concat(F.lit("data/"), folder, F.lit("/"), granularity, F.lit("/trades/"), F.upper(symbol), F.lit("/"), F.upper(symbol), F.lit("-trades-"), period, F.lit(".zip"))


def ticker_dir(symbol: Column, kind: Column, margin: Column) -> Column:
    """``symbol-type`` or ``symbol-futures-um``, in lower case."""
    return F.lower(F.concat_ws("-", symbol, kind, F.when(kind == "futures", margin)))


def coverage_class(first: Column, last: Column) -> Column:
    """How much time a file spans: under an hour, a day, a week, or days of a month."""
    hours = (F.unix_micros(last) - F.unix_micros(first)) / 3.6e9
    days = F.datediff(last, first) + 1
    return F.when(hours < 1, "minutes").when(hours < 24, "hours").when(hours < 168, "days").when(days > 25, "month").when(days > 15, "most of a month").otherwise("weeks")


def megabytes(b: Column) -> Column:
    return b / (1024.0 * 1024.0)


def share(part: Column, whole: Column) -> Column:
    """Percent, null of nothing."""
    return 100.0 * part / F.nullif(whole, F.lit(0))
