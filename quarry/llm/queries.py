"""Registered queries of this subpackage and their DuckDB oracle texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import (chat_format, decontaminate, fingerprints, jaccard_join, language_id, mixing, prefix_trie, quality, token_counts,
                        token_ids, toxicity, turn_repair, warc)
from quarry.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(), limit=1024)


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_ids(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.report(table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_report(table(spark, sf_dir, "pages"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.components(table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.report(table(spark, sf_dir, "conversations"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.report(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_token_ids, op3_language_id, op4_fingerprints, op5_quality, op6_mixing,
                            op7_toxicity, op8_warc, op9_jaccard_join, op10_benchmark_decontamination,
                            op11_prefix_trie, op12_turn_repair, op13_chat_format, pipeline)
}
ORACLE: dict[str, str] = {
    "op6_mixing": mixing.oracle_sql(),
    "op8_warc": warc.ORACLE_SQL,
    "op10_benchmark_decontamination": decontaminate.ORACLE_SQL,
    "op11_prefix_trie": prefix_trie.oracle_sql(),
    "op12_turn_repair": turn_repair.oracle_sql(),
    "op13_chat_format": chat_format.oracle_sql(),
}
