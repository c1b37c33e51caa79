"""The registered queries of these operators: each applies one of them to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from . import decontaminate, line_templates, near_dup, pii, quality, token_blocks, token_counts, toxicity, trie_bpe, wrappers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_templates.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_lines.all").alias("n_lines"), F.col("_lines.dropped").alias("n_dropped"), "text")


def op2_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.token_blocks(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op7_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.main_text(table(spark, sf_dir, "pages"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op10_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_line_templates, op2_token_blocks, op3_decontamination, op4_toxicity, op5_simhash, op6_quality, op7_wrappers, op8_pii, op9_token_counts, op10_bpe_trie)}


def oracle_sql() -> dict[str, str]:
    return {"op1_line_templates": line_templates.ORACLE}
