"""Spam flag by repeated text starts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mention_pulse.functions.text import clean_text, prefix_key
from mention_pulse.operators.skew import HOT_ROWS, copy_to_slices, hot_keys, slice_rows

KEY = "tweet_text_clean_sub25"


def with_clean_text(
    posts: DataFrame, text: str = "tweet_text_text", url_mode: str = "greedy", size: int = 25
) -> DataFrame:
    """Add the cleaned text and its spam key."""
    return posts.withColumn("tweet_text_clean", clean_text(text, url_mode)).withColumn(
        KEY, prefix_key("tweet_text_clean", size)
    )


def flag_spam(
    posts: DataFrame,
    threshold: int = 1,
    count_unit: str = "mention",
    key: str = KEY,
    post_id: str = "tweet_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add `possible_spam`: the key is seen more than `threshold` times in the frame.

    'mention' counts rows, so a post with two tickers repeats itself; 'post' counts distinct
    posts. A null key is never spam. The counts are combined before they are shuffled, and only
    repeated keys are joined back; the rows of a key above `hot_rows` are dealt over several tasks.
    """
    if count_unit not in ("mention", "post"):
        raise ValueError(f"count_unit {count_unit!r} is neither 'mention' nor 'post'")
    # count(key) gives 0 for a null key, and the join below is null-safe: neither makes Spark
    # test the key for null below the counts, which would clean every text once more there
    rows = posts.groupBy(key).agg(F.count(key).alias("_rows"))
    if count_unit == "post":
        seen = posts.select(key, post_id).distinct().groupBy(key).agg(F.count(key).alias("_seen"))
    else:
        seen = rows.withColumnRenamed("_rows", "_seen")
    hot = hot_keys(rows, key, "_rows", hot_rows)
    repeated = seen.filter(F.col("_seen") > threshold).select(F.col(key).alias("_key"))
    left = slice_rows(posts, key, post_id, hot)
    right = copy_to_slices(repeated, "_key", hot).withColumnRenamed("_slice", "_copy")
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_slice") == F.col("_copy"))
    joined = left.join(right, same, "left")
    return joined.withColumn("possible_spam", F.col("_key").isNotNull()).drop(
        "_key", "_copy", "_slice"
    )


def spam_profile(flagged: DataFrame, post_id: str = "tweet_id") -> DataFrame:
    """Distinct posts per flag."""
    return (
        flagged.select("possible_spam", post_id)
        .distinct()
        .groupBy("possible_spam")
        .agg(F.count(F.lit(1)).alias("n_posts"))
    )
