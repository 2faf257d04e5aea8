"""Encoded records: base64 text holding one JSON line each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mention_pulse.operators.capture import FAILED, is_relevant, with_status
from mention_pulse.operators.sentiment import Lexicon, pack_scores
from mention_pulse.schemas import POSTS_RAW, POSTS_SCORED


def decode_records(
    records: DataFrame, schema: T.StructType = POSTS_RAW, data: str = "data"
) -> DataFrame:
    """Add struct column `post`: base64 to UTF-8 to trimmed JSON; null where any step fails."""
    text = F.trim(F.try_to_binary(F.col(data), F.lit("base64")).cast("string"), F.lit(" \t\r\n"))
    return records.withColumn("post", F.from_json(text, schema))


def encode(columns: list[str]) -> Column:
    """Base64 of one JSON line made of the columns."""
    return F.base64(F.concat(F.to_json(F.struct(*columns)), F.lit("\n")).cast("binary"))


def encode_records(posts: DataFrame, record_id: str = "recordId") -> DataFrame:
    """(recordId, data) of posts with a record id; all other columns go into the data."""
    columns = [c for c in posts.columns if c != record_id]
    return posts.select(record_id, encode(columns).alias("data"))


def transform_records(records: DataFrame, lexicon: Lexicon) -> DataFrame:
    """(recordId, result, data): score relevant records, pass the others on marked.

    A record which cannot be read is handed back unchanged as failed.
    """
    decoded = decode_records(records).select("recordId", F.col("data").alias("_raw"), "post")
    unread = F.col("post.tweet_id").isNull()
    posts = decoded.select("recordId", "_raw", unread.alias("_unread"), "post.*")
    scored = with_status(pack_scores(posts, lexicon, when=is_relevant()))
    return scored.select(
        "recordId",
        F.when(F.col("_unread"), FAILED).otherwise(F.col("result")).alias("result"),
        F.when(F.col("_unread"), F.col("_raw"))
        .otherwise(encode(POSTS_SCORED.fieldNames()))
        .alias("data"),
    )
