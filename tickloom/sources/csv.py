"""Raw trade files as text: any header or none, epochs of any unit, broken rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.scalars import epoch_ms, flag
from ..schema import ALIASES, FUTURES_FIELDS, SPOT_FIELDS


def typed(fields: DataFrame, missing_best_match: bool | None = False, width: int | None = None) -> DataFrame:
    """Text fields ``f`` (an array per row) -> trades.

    Rows of another number of fields than ``width`` (6 or 7; default: either) and rows whose numbers don't parse go;
    that takes headers along, whatever their names. A missing last flag becomes ``missing_best_match``.
    """
    f = F.col("f")
    n = F.size(f)
    rows = fields.where(n == width if width else n.isin(6, 7))
    at = lambda i: F.trim(F.get(f, i))
    best: Column = F.when(F.size(f) > 6, flag(at(6))).otherwise(F.lit(missing_best_match).cast("boolean"))
    out = rows.select(
        at(0).try_cast("long").alias("trade_id"), at(1).try_cast("double").alias("price"), at(2).try_cast("double").alias("qty"), at(3).try_cast("double").alias("quoteQty"), at(4).try_cast("long").alias("t"),
        flag(at(5)).alias("isBuyerMaker"), best.alias("isBestMatch"), *[c for c in fields.columns if c != "f"],
    )
    out = out.where(" AND ".join(f"{c} IS NOT NULL" for c in ("trade_id", "price", "qty", "quoteQty", "t")))
    out = out.withColumn("time", F.timestamp_millis(epoch_ms(F.col("t")))).drop("t")
    return out.select(*SPOT_FIELDS, *[c for c in fields.columns if c != "f"])


def by_name(fields: DataFrame, file_col: str, least: int = 4) -> DataFrame:
    """Fields ``f`` in our order, by the header of each file, known by ``file_col``; files without a header keep their order.

    A header is a row with at least ``least`` known names (any case, with their aliases) among its fields. Of a file with
    a header, rows of another number of fields go.
    """
    known = {c.lower(): c for c in SPOT_FIELDS} | ALIASES
    names = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    header = F.transform("f", lambda x: F.coalesce(names[F.lower(F.trim(x))], F.lit("")))
    headers = fields.select(F.col(file_col).alias("_file"), header.alias("_names")).where(F.size(F.array_intersect("_names", F.array(*map(F.lit, SPOT_FIELDS)))) >= least)
    headers = headers.groupBy("_file").agg(F.min("_names").alias("_names"))
    both = fields.join(headers, fields[file_col] == headers["_file"], "left")

    def field(c: str) -> Column:
        return F.get("f", F.array_position("_names", c).cast("int") - 1)

    ours = F.when(F.array_contains("_names", SPOT_FIELDS[-1]), F.array(*map(field, SPOT_FIELDS))).otherwise(F.array(*map(field, FUTURES_FIELDS)))
    f = F.when(F.col("_names").isNull(), F.col("f")).when(F.size("f") == F.size("_names"), ours)
    return both.select(*[c for c in fields.columns if c != "f"], f.alias("f")).where("f is not null")


def read_csv(spark: SparkSession, path: str, missing_best_match: bool | None = False, width: int | None = None, headers: bool = True) -> DataFrame:
    """Trades of CSV files with or without headers, columns of a headered file by their names. Plain text lines keep files splittable.

    ``headers=False``: the files have none, so the pass that looks for them is saved.
    """
    lines = spark.read.text(path).select(F.split("value", ",").alias("f"), F.col("_metadata.file_path").alias("_path"))
    if not headers:
        return typed(lines.select("f"), missing_best_match, width)
    return typed(by_name(lines, "_path").select("f"), missing_best_match, width)


def write_csv(trades: DataFrame, path: str) -> None:
    """Headerless files, times in milliseconds."""
    out = trades.withColumn("time", F.unix_millis("time")).select(*SPOT_FIELDS)
    out.write.option("header", False).csv(path)


def harmonise(trades: DataFrame, missing_best_match: bool | None = False) -> DataFrame:
    """Any trade table to the canonical columns, order and types."""
    from ..schema import TRADES

    df = trades.withColumnsRenamed({a: b for a, b in ALIASES.items() if a in trades.columns and b not in trades.columns})
    if "isBestMatch" not in df.columns:
        df = df.withColumn("isBestMatch", F.lit(missing_best_match).cast("boolean"))
    return df.select(*[F.coalesce(F.col(f.name).cast(f.dataType), F.lit(missing_best_match).cast("boolean")).alias(f.name) if f.name == "isBestMatch" else F.col(f.name).cast(f.dataType).alias(f.name) for f in TRADES])
