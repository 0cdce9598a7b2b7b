"""The operators as queries over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowspark.llm import (
    chat_format,
    fill_in_middle,
    fingerprints,
    line_dedup,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    simhash,
    substring_dedup,
    token_counts,
    warc,
    whitening,
)
from flowspark.llm.common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing(table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, sf_dir, "documents"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality_classifier(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-7, 0, "user", control), (-7, 1, "assistant", control)], rows.schema
    )
    return chat_format.digests(chat_format.format_conversations(rows.unionByName(added)))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_near_dedup(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(
        fill_in_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.embedding_whitening(table(spark, sf_dir, "embeddings"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op3_mixing": op3_mixing,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_line_dedup": op7_line_dedup,
    "op8_chat_format": op8_chat_format,
    "op9_packing": op9_packing,
    "op10_simhash": op10_simhash,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_whitening": op12_whitening,
    "op13_warc": op13_warc,
}

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": quality_rules.ORACLE_SQL,
    "op3_mixing": mixing.ORACLE_SQL,
    "op7_line_dedup": line_dedup.ORACLE_SQL,
    "op11_fill_in_middle": fill_in_middle.ORACLE_SQL,
    "op13_warc": warc.ORACLE_SQL,
}
