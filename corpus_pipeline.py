"""The corpus pipeline: quality rules, near-duplicates, benchmark leaks, personal data, piece ids.

Every stage works on the rows its predecessor kept; run() writes each stage's rows to the folder that
driver and executors share (spark.checkpoint.dir) and reads them again, so no stage repeats another and
a lost executor costs its own tasks only. All stages but the last give the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mention_pulse.llm import common, decontamination, pieces, pii, quality_rules, simhash
from mention_pulse.llm.queries import PIECE_BPE

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontamination.without_leaks(docs, common.documents(spark, sf_dir, "benchmark"))


def mask_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked in their texts."""
    return pii.mask(docs)


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and decoded text of each document."""
    return pieces.encode(docs, public_tokenizers.path(PIECE_BPE))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_quality),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_leaks),
    ("personal_data", mask_personal),
    ("pieces", to_pieces),
]

# SimHash components, latent retrieval and piece merging have no SQL form: tests hold run() against brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to the documents table."""
    docs = common.documents(spark, sf_dir)
    folder = common.shared_folder(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
