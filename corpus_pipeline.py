"""A corpus pipeline of five stages. Each takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes what a
stage returns as Parquet in the shared folder and hands what it reads there to the next one.

The first four return the columns of documents: poor documents go; lines that an earlier document has go, and with
them documents that have no words left; of near-duplicates one document stays; documents with a leaked benchmark item
go. The last encodes and decodes what is left.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickloom.llm import decontaminate, line_templates, near_dup, quality, trie_bpe
from tickloom.llm.store import scratch, written
from tickloom.ship import ship


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.drop_poor(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_templates.drop_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return trie_bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality", quality_rules), ("lines", line_dedup), ("near_dup", near_dedup), ("decontamination", decontamination), ("bpe", bpe)]

#: Fingerprints, robust estimates and merges can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    with scratch(spark) as keep:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in STAGES:
            docs = stored(spark, name, stage, docs, sf_dir)
        return keep(docs)


def stored(spark: SparkSession, name: str, stage, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What a stage returns, stored; the tables that it made on the way are deleted then."""
    with scratch(spark) as keep:
        return keep(written(stage(spark, docs, sf_dir), f"pipeline-{name}"))
