"""Root of a reply thread, by walking reply links a bounded number of steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mention_pulse.functions.text import extract_tags
from mention_pulse.operators.skew import HOT_ROWS, copy_to_slices, hot_keys, slice_rows
from mention_pulse.sources.tables import kept


def resolve_root(
    posts: DataFrame,
    max_hops: int = 5,
    post_id: str = "tweet_id",
    parent: str = "parent_id",
    text: str = "text",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(post_id, root_id, root_text, hops) of every reply whose root is found.

    Works from the roots outwards: replies to a root are one hop away, replies to those two, and
    so on. A reply thus enters exactly one level. Hops carry ids only; each level is written once
    and read by the next, so a hop is one join, whatever the number of hops. Texts are joined last.
    A post with very many direct replies, or a root with a very long thread, is cut into slices.
    Replies to a missing post, or deeper than `max_hops`, are absent. Ids must be distinct.
    """
    ids = posts.select(F.col(post_id).alias("_id"), F.col(parent).alias("_parent"))
    replies = ids.filter("_parent IS NOT NULL")
    hot = kept(hot_keys(_counts(replies, "_parent"), "_parent", "_n", hot_rows), "hot_parents")
    waiting = kept(slice_rows(replies, "_parent", "_id", hot), "replies")
    level = ids.filter("_parent IS NULL").select(F.col("_id").alias("_at"), F.col("_id").alias("root_id"))
    levels = []
    for hop in range(1, max_hops + 1):
        upper = copy_to_slices(level, "_at", hot).withColumnRenamed("_slice", "_copy")
        found = waiting.join(
            upper, (F.col("_parent") == F.col("_at")) & (F.col("_slice") == F.col("_copy")), "inner"
        )
        level = kept(found.select(F.col("_id").alias("_at"), "root_id"), f"hop{hop}")
        levels.append(level.withColumn("hops", F.lit(hop)))
    found = reduce(DataFrame.unionByName, levels).withColumnRenamed("_at", post_id)
    return with_root_text(found, posts, post_id, parent, text, hot_rows)


def with_root_text(
    found: DataFrame,
    posts: DataFrame,
    post_id: str = "tweet_id",
    parent: str = "parent_id",
    text: str = "text",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(post_id, root_id, root_text, hops) of (post_id, root_id, hops), by the texts of the roots alone."""
    long = hot_keys(_counts(found, "root_id"), "root_id", "_n", hot_rows)
    texts = posts.filter(F.col(parent).isNull()).select(
        F.col(post_id).alias("_root"), F.col(text).alias("root_text")
    )
    texts = copy_to_slices(texts, "_root", long).withColumnRenamed("_slice", "_copy")
    same = (F.col("root_id") == F.col("_root")) & (F.col("_slice") == F.col("_copy"))
    return slice_rows(found, "root_id", post_id, long).join(texts, same).select(
        post_id, "root_id", "root_text", "hops"
    )


def _counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))


def attach_root(posts: DataFrame, roots: DataFrame, post_id: str = "tweet_id") -> DataFrame:
    """Posts with their root beside them, null where none was found."""
    return posts.join(roots, post_id, "left")


def with_parent(
    posts: DataFrame,
    max_hops: int = 5,
    post_id: str = "tweet_id",
    parent: str = "parent_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fill `reference_tweets` of replies with the original post of their thread and its tags."""
    roots = resolve_root(posts, max_hops, post_id, parent, "text", hot_rows)
    found = F.struct(
        F.col("root_id").cast("string").alias("tweet_id"),
        F.lit("original").alias("tweet_type"),
        F.col("root_text").alias("text"),
        extract_tags("root_text").alias("hashcashtags"),
    )
    return (
        attach_root(posts, roots, post_id)
        .withColumn("reference_tweets", F.when(F.col("root_id").isNotNull(), found))
        .drop("root_id", "root_text", "hops")
    )
