"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, exact_dedup, language_id, line_dedup, minhash, mixing, ppm, quality_model, quality_rules, warc
from .common import table


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_derivatives(table(spark, sf_dir, "pages"))


def op5_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_documents(table(spark, sf_dir, "documents"))


def op6_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_line_dedup, op3_mix, op4_warc, op5_ppm, op6_quality_model, op7_minhash, op8_quality_rules, op9_exact_dedup, op10_language_id)}
ORACLE = {"op3_mix": mixing.ORACLE, "op9_exact_dedup": exact_dedup.ORACLE}
