"""From posts to mentions: one row per post and tracked ticker."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mention_pulse.functions.text import union_tags
from mention_pulse.operators.skew import join_dimension, small_values

OWN, PARENTS = "tweet_meta_hashcashtags", "reference_tweets_hashcashtags"


def top_tickers(dim: DataFrame, n: int = 100) -> DataFrame:
    """The n heaviest tickers of the dimension."""
    return dim.filter(F.col("sno") <= n).orderBy("sno").select("ticker", "ticker_name")


def explode_tags(posts: DataFrame, own: str = OWN, parents: str = PARENTS) -> DataFrame:
    """One row per post and distinct tag, every other column carried along."""
    return posts.withColumn("tag", F.explode(union_tags(own, parents))).drop(own, parents)


def match_tickers(
    tags: DataFrame, tickers: DataFrame, post_id: str = "tweet_id", **limits: int
) -> DataFrame:
    """Keep the rows whose tag is a tracked ticker. Works on a stream of tags as well."""
    return join_dimension(tags, tickers, "tag", "ticker", post_id, **limits).drop("tag")


def with_ticker_list(mentions: DataFrame, *by: str) -> DataFrame:
    """All distinct tickers of a post beside each of its mentions, and their number.

    `by` tells posts apart (the id alone by default).
    """
    tickers = F.array_sort(F.collect_set("ticker").over(Window.partitionBy(*(by or ("tweet_id",)))))
    return mentions.withColumn("ticker_ls", tickers).withColumn("ticker_sz", F.size("ticker_ls"))


def attach_posts(mentions: DataFrame, posts: DataFrame, post_id: str = "tweet_id") -> DataFrame:
    """Mentions joined to whole posts by id; posts without a mention fall out."""
    return mentions.join(posts, post_id, "inner")


def tag_mentions(
    posts: DataFrame, tickers: DataFrame, own: str = OWN, parents: str = PARENTS
) -> DataFrame:
    """Posts to mentions with `ticker`, `ticker_name`, `ticker_ls` and `ticker_sz`.

    The list holds the distinct tickers of the post's own row, also where posts share an id or the
    dimension repeats a ticker. The symbols of a dimension of checked size travel inside the query
    as a set, so nothing is shuffled. A larger dimension is joined, and the lists are gathered by
    post id and tags: a list follows from the tags, so rows alike in both have the same one.
    """
    tracked = small_values(tickers, "ticker")
    if tracked is None:
        tagged = posts.withColumn("_tags", F.sort_array(union_tags(own, parents)))
        matched = match_tickers(explode_tags(tagged, own, parents), tickers)
        return with_ticker_list(matched, "tweet_id", "_tags").drop("_tags")
    known = F.filter(union_tags(own, parents), lambda tag: tag.isin(tracked))
    # explode_outer: for a plain explode Spark would test the list for emptiness first, making it
    # twice; the join drops the posts without a ticker anyway
    mentions = (
        posts.withColumn("ticker_ls", F.sort_array(known))
        .drop(own, parents)
        .withColumn("ticker_sz", F.size("ticker_ls"))
        .withColumn("tag", F.explode_outer("ticker_ls"))
    )
    return mentions.join(F.broadcast(tickers), F.col("tag") == F.col("ticker"), "inner").drop("tag")


def kept_posts(mentions: DataFrame, post_id: str = "tweet_id") -> DataFrame:
    """Exact number of distinct posts that still have a mention."""
    return mentions.agg(F.countDistinct(post_id).alias("kept_posts"))
