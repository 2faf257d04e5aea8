"""Which posts are taken in, and how a record fares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mention_pulse.functions.text import all_tags, has_word
from mention_pulse.operators.skew import join_dimension, small_values

# The words which exclude a post from capture.
EXCLUDED_WORDS = ("algo", "software", "alerts")
TERM_PATTERN = r"[#$][\p{L}\p{N}_]+"

OK, DROPPED, FAILED = "Ok", "Dropped", "ProcessingFailed"


def symbol_terms(tickers: DataFrame) -> DataFrame:
    """Search terms of the tracked tickers: $X and #X."""
    both = F.array(F.concat(F.lit("$"), "ticker"), F.concat(F.lit("#"), "ticker"))
    return tickers.select(F.explode(both).alias("term"))


def capture_filter(
    posts: DataFrame,
    tickers: DataFrame,
    lang: str = "en",
    exclude: Sequence[str] = EXCLUDED_WORDS,
    post_id: str = "tweet_id",
) -> DataFrame:
    """Posts (with `text`, `lang`, `tweet_type`) that the capture rule lets in.

    Not a repost, in the language, free of the excluded words, and naming a tracked ticker as $X
    or #X; naming one implies having a tag. Each post is judged by its own text, ids need not be
    distinct.
    """
    rule = (F.col("tweet_type") != "retweeted") & (F.col("lang") == lang)
    if exclude:
        rule = rule & ~has_word("text", exclude)
    wanted = posts.filter(rule)
    terms = F.regexp_extract_all(F.upper("text"), F.lit(TERM_PATTERN), F.lit(0))
    symbols = symbol_terms(tickers).select(F.upper("term").alias("symbol")).distinct()
    listed = small_values(symbols, "symbol")
    if listed is not None:
        return wanted.filter(F.exists(terms, lambda term: term.isin(listed)))
    # the verdict follows from the terms, so posts alike in id and terms share it
    termed = wanted.withColumn("_terms", F.array_distinct(terms))
    named = termed.select(F.col(post_id).alias("_id"), "_terms", F.explode("_terms").alias("term"))
    hits = join_dimension(named, symbols, "term", "symbol", "_id").select("_id", F.col("_terms").alias("_hit"))
    same = F.col(post_id).eqNullSafe(F.col("_id")) & (F.col("_terms") == F.col("_hit"))
    return termed.join(hits, same, "left_semi").drop("_terms")


def record_tags() -> Column:
    """Own and parent's tags of a nested post."""
    return all_tags("tweet_meta.hashcashtags", "reference_tweets.hashcashtags")


def is_relevant() -> Column:
    """Not sensitive (unknown counts as not) and with a tag of its own or its parent's."""
    return ~F.coalesce(F.col("tweet_meta.sensitive"), F.lit(False)) & (F.size(record_tags()) > 0)


def keep_relevant(posts: DataFrame) -> DataFrame:
    """Drop sensitive posts and posts without any tag."""
    return posts.filter(is_relevant())


def with_status(scored: DataFrame) -> DataFrame:
    """Add `result` to scored posts: Dropped, ProcessingFailed (no score came out) or Ok."""
    parent_failed = F.col("reference_tweets").isNotNull() & F.col(
        "reference_tweets.tweet_text.sentiment"
    ).isNull()
    failed = F.col("tweet_text.sentiment").isNull() | parent_failed
    return scored.withColumn(
        "result", F.when(~is_relevant(), DROPPED).when(failed, FAILED).otherwise(OK)
    )
