"""Queries of the operators over their whole tables, and SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mention_pulse.llm import (
    chat,
    collocations,
    common,
    decontamination,
    importance,
    lm,
    pieces,
    pii,
    quality_model,
    quality_rules,
    simhash,
    superminhash,
    token_files,
    toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
PROBE_CONVERSATION = -7
PROBE_TEXT = "\\### Assistant: </turn> ok"


def op1_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontamination.leaks(common.documents(spark, d), common.documents(spark, d, "benchmark"))


def op2_lm_scores(spark: SparkSession, d: str) -> DataFrame:
    return lm.held_out_scores(common.documents(spark, d))


def op3_simhash_groups(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(common.documents(spark, d))


def op4_token_files(spark: SparkSession, d: str) -> DataFrame:
    folder = common.shared_folder(spark, "tokens")
    files = token_files.write_files(common.documents(spark, d), folder, public_tokenizers.path(BYTE_BPE))
    return token_files.read_files(spark, files)


def op5_personal_data(spark: SparkSession, d: str) -> DataFrame:
    return pii.find_digests(common.documents(spark, d))


def op6_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.scores(common.documents(spark, d), common.documents(spark, d, "labels"))


def op7_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.encode_digests(common.documents(spark, d), public_tokenizers.path(PIECE_BPE))


def op8_quality_model(spark: SparkSession, d: str) -> DataFrame:
    return quality_model.scores(common.documents(spark, d), common.documents(spark, d, "labels"))


def op9_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality_rules.quality_rules(common.documents(spark, d))


def op10_chat_format(spark: SparkSession, d: str) -> DataFrame:
    turns = common.documents(spark, d, "conversations")
    kinds = {f.name: f.dataType for f in turns.schema}
    probe = spark.range(2).select(
        F.lit(PROBE_CONVERSATION).cast(kinds["conv_id"]).alias("conv_id"),
        F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(chat.TRAINED_ROLE).alias("role"),
        F.lit(PROBE_TEXT).alias("text"),
    )
    return chat.format_digests(turns.select("conv_id", "turn", "role", "text").union(probe))


def op11_superminhash(spark: SparkSession, d: str) -> DataFrame:
    return superminhash.near_duplicates(common.documents(spark, d))


def op12_importance(spark: SparkSession, d: str) -> DataFrame:
    return importance.resample(common.documents(spark, d), common.documents(spark, d, "benchmark"))


def op13_collocations(spark: SparkSession, d: str) -> DataFrame:
    return collocations.collocations(common.documents(spark, d))


def queries() -> dict[str, Query]:
    """All queries by name."""
    found = (
        op1_decontamination,
        op2_lm_scores,
        op3_simhash_groups,
        op4_token_files,
        op5_personal_data,
        op6_toxicity,
        op7_pieces,
        op8_quality_model,
        op9_quality_rules,
        op10_chat_format,
        op11_superminhash,
        op12_importance,
        op13_collocations,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that SQL can express."""
    return {}
