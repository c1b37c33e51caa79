"""Intermediate tables in the folder that the cluster shares, and joins that needn't move texts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows of keys (two longs) that one broadcast may hold: about 32 MB.
BROADCAST_ROWS = 500_000
#: Words of 64 bits in the filter that goes before a join of more keys.
FILTER_WORDS = 1 << 20

_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, as in tests, a folder of this machine if the master is local; else an error."""
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        conf = spark.sparkContext._jsc.sc().getCheckpointDir()
        conf = conf.get() if conf.isDefined() else None
    if not conf:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir isn't set: a cluster needs a folder that all its machines share")
        conf = "file://" + os.path.join(tempfile.gettempdir(), f"checkpoints-{os.getuid()}")
    return conf.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, whole files, no lineage behind it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes at its end the tables that were ``written`` inside it, but for the last one before ``keep(table)``, which it hands over."""
    made: list[str] = []
    _scopes.append(made)

    def keep(table: DataFrame) -> DataFrame:
        made.pop()
        return table

    try:
        yield keep
    finally:
        _scopes.remove(made)
        for path in made:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def marks(keys: list[Column]) -> list[tuple[Column, Column]]:
    """(word, bit) of a row in the filter, twice."""
    bits = F.lit(FILTER_WORDS * 64)
    places = [F.pmod(F.xxhash64(*keys, F.lit(k)), bits) for k in (1, 2)]
    return [(F.shiftright(p, 6).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(p, F.lit(64)).cast("int"))) for p in places]


def filter_of(keys: DataFrame, name: str) -> DataFrame:
    """One row with the column ``name``: a Bloom filter of the rows of ``keys``, FILTER_WORDS longs whatever their number."""
    pairs = F.array(*[F.struct(w.alias("w"), m.alias("m")) for w, m in marks([F.col(c) for c in keys.columns])])
    words = keys.select(F.inline(pairs)).groupBy("w").agg(F.bit_or("m").alias("m"))
    all_words = keys.sparkSession.range(FILTER_WORDS).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("m"))
    dense = words.union(all_words).groupBy("w").agg(F.bit_or("m").alias("m"))
    return dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", "m"))), lambda x: x["m"]).alias(name))


def may_have(bits: Column, keys: list[Column]) -> Column:
    """Whether a row may be in the filter ``bits``; false for rows with a null key."""
    found = [F.get(bits, w).bitwiseAND(m) != 0 for w, m in marks(keys)]
    there = found[0] & found[1]
    for k in keys:
        there = there & k.isNotNull()
    return F.coalesce(there, F.lit(False))


def without(docs: DataFrame, gone: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """The rows of ``docs`` whose ``keys`` (name -> expression) aren't in ``gone``, a written table of those names.

    Null keys are in no table. Up to BROADCAST_ROWS rows of ``gone`` are broadcast. More of them make a Bloom filter of
    fixed size: rows that it excludes stay where they are, and only the others are shuffled to be compared exactly.
    """
    names = [f"_key{i}_{uuid.uuid4().hex[:8]}" for i in range(len(keys))]
    gone = gone.select(*[F.col(c).alias(n) for c, n in zip(keys, names, strict=True)]).distinct()
    columns = [F.col(f"`{c}`") for c in docs.columns]

    def rest(rows: DataFrame, gone: DataFrame) -> DataFrame:
        on = [e == F.col(n) for e, n in zip(keys.values(), names, strict=True)]
        test = on[0]
        for x in on[1:]:
            test = test & x
        return rows.join(gone, test, "left_anti")

    if gone.count() <= BROADCAST_ROWS:
        return rest(docs, F.broadcast(gone))
    bits = f"_filter_{uuid.uuid4().hex[:8]}"
    marked = docs.join(F.broadcast(filter_of(gone, bits)))  # one row of FILTER_WORDS longs
    test = may_have(F.col(bits), list(keys.values()))
    return marked.where(~test).select(*columns).unionByName(rest(marked.where(test).select(*columns), gone))
