"""ZIP archives of trade files, with checksums beside them."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.merge import first_by, verify
from ..ship import ship
from .csv import by_name, typed

#: Two members whose sizes differ by less are the same file twice.
SAME_SIZE = 0.10
LINES = 50_000


def members(z: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    """CSV members to read: root ones before those in folders; of near-equal sizes the first, else all."""
    found = [i for i in z.infolist() if i.filename.lower().endswith(".csv") and not i.is_dir()]
    root = [i for i in found if "/" not in i.filename]
    found = root or found
    if len(found) > 1:
        sizes = sorted(i.file_size for i in found)
        if sizes[-1] and (sizes[-1] - sizes[0]) / sizes[-1] < SAME_SIZE:
            return found[:1]
    return found


def files(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    """``name, path, length, content``; the content is read only if it is used."""
    b = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return b.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", "length", "content")


def checked(spark: SparkSession, path: str) -> DataFrame:
    """Archives with ``status``: ok, mismatch or unchecked, by the ``.CHECKSUM`` files beside them."""
    sums = spark.read.option("wholetext", True).option("pathGlobFilter", "*.CHECKSUM").text(path)
    sums = sums.select(F.regexp_replace(F.element_at(F.split(F.input_file_name(), "/"), -1), r"\.CHECKSUM$", "").alias("name"), F.col("value").alias("checksum"))
    return verify(files(spark, path), sums, "name")


def intact(archives: DataFrame) -> DataFrame:
    """``name, intact``: whether each archive opens and its checks hold."""
    ship(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for content in batch.column("content"):
                try:
                    with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                        good.append(z.testzip() is None)
                except zipfile.BadZipFile:
                    good.append(False)
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array(good, pa.bool_())], names=["name", "intact"])

    return archives.select("name", "content").mapInArrow(run, "name string, intact boolean")


def lines(archives: DataFrame) -> DataFrame:
    """``name, value``: the lines of the archives' members, read as streams."""
    ship(archives.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name").to_pylist(), batch.column("content"), strict=True):
                with zipfile.ZipFile(io.BytesIO(content.as_py())) as z:
                    for member in members(z):
                        held: list[str] = []
                        with io.TextIOWrapper(z.open(member), "utf-8", errors="replace") as f:
                            for line in f:
                                held.append(line.rstrip("\r\n"))
                                if len(held) == LINES:
                                    yield pa.RecordBatch.from_pydict({"name": [name] * len(held), "value": held})
                                    held = []
                        if held:
                            yield pa.RecordBatch.from_pydict({"name": [name] * len(held), "value": held})

    return archives.select("name", "content").mapInArrow(run, "name string, value string")


def read_archives(spark: SparkSession, path: str, missing_best_match: bool | None = False, verified: bool = True) -> DataFrame:
    """Trades of all archives under ``path`` with ``name``; an archive whose checksum differs is an error."""
    if verified:
        bad = [r.name for r in checked(spark, path).where("status = 'mismatch'").select("name").limit(5).collect()]
        if bad:
            raise ValueError(f"checksums differ: {', '.join(bad)}")
    text = lines(files(spark, path))
    trades = typed(by_name(text.select("name", F.split("value", ",").alias("f")), "name"), missing_best_match)
    # Members of one archive may overlap: each trade once.
    return first_by(trades, ["name", "trade_id"], [c for c in trades.columns if c not in ("name", "trade_id")])
