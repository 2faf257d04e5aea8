"""Bounded samples of labelled documents, for classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mention_pulse.llm.lm import fold


def labelled(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held: int, bound: int) -> DataFrame:
    """doc_id, text, label and `part` (0 to 9) of at most about `bound` labelled rows outside the fold `held`.

    The rows taken are those whose hash of doc_id is lowest, so the sample does not depend on the layout
    of the tables. Labels other than 0 and 1 are passed over; of several for a doc_id the larger counts.
    """
    own = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
    own = own.filter(fold(modulus) != held).groupBy("doc_id").agg(F.max("label").alias("label"))
    ids = own.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(bound)
    ids = ids.select(F.col("doc_id").alias("of_doc"), "label", F.pmod(F.xxhash64("h"), F.lit(10)).alias("part"))
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # at most `bound` ids are sent to the tasks
    return texts.join(F.broadcast(ids), F.col("doc_id") == F.col("of_doc")).select("doc_id", "text", "label", "part")
