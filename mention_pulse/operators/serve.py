"""Questions a dashboard asks of the serving tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mention_pulse.functions.keys import check_level, key_ts, spread_key, time_key
from mention_pulse.schemas import COUNTERS, TEXTS_AT

# Fixed value: the lower time bound when a caller gives none.
DEFAULT_START = "2022-10-15 00:00:00"
SORT_CHOICES = COUNTERS


# ---- ticker roll-up ------------------------------------------------------------------------
def at_level(rollup: DataFrame, key: str, ticker: str | None = None) -> DataFrame:
    """All tickers (or one) of a level key, ticker descending."""
    rows = rollup.filter(F.col("DetailLevel") == key)
    if ticker is not None:
        rows = rows.filter(F.col("TICKER") == ticker)
    return rows.orderBy(F.desc("TICKER"))


def with_ratios(rollup: DataFrame) -> DataFrame:
    """Add the share of each class among the mentions."""
    return rollup.withColumns(
        {f"{c}_R": F.try_divide(F.col(c), F.col("NUM_MENTIONS")) for c in COUNTERS[1:]}
    )


def leaderboard(
    rollup: DataFrame, key: str, sort_by: str = "NUM_MENTIONS", n: int = 10
) -> DataFrame:
    """Top n tickers of a level key: by mentions, or by the share (not the number) of a class."""
    if sort_by not in SORT_CHOICES:
        raise ValueError(f"{sort_by!r} is none of {SORT_CHOICES}")
    order = sort_by if sort_by == "NUM_MENTIONS" else f"{sort_by}_R"
    rows = with_ratios(rollup.filter(F.col("DetailLevel") == key))
    return rows.orderBy(F.desc(order), F.desc("TICKER")).limit(n)


def in_range(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows by time key, compared as text: after `start`, or between both ends."""
    start = start or DEFAULT_START
    stamp = F.col("TIMESTAMP")
    return df.filter(stamp > start if end is None else stamp.between(start, end))


def ticker_detail_of(ticker: str, level: str) -> str:
    """`TickerDetail` of a ticker at a level."""
    return f"{ticker.upper()}_{check_level(level)}"


def _of_ticker(rollup: DataFrame, ticker: str, level: str) -> DataFrame:
    return rollup.filter(F.col("TickerDetail") == ticker_detail_of(ticker, level))


def trend(
    rollup: DataFrame, ticker: str, level: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Periods of a ticker at a level, newest first, with the time of their first mention."""
    rows = in_range(_of_ticker(rollup, ticker, level), start, end)
    return rows.withColumn("FIRST_SEEN", key_ts("TIMESTAMP")).orderBy(F.desc("TIMESTAMP"))


def trend_between_dates(
    rollup: DataFrame, ticker: str, level: str, first: dt.date, last: dt.date
) -> DataFrame:
    """Trend between two dates, both included."""
    day = F.to_date("FIRST_SEEN")
    return trend(rollup, ticker, level).filter(day.between(F.lit(first), F.lit(last)))


def latest_periods(
    rollup: DataFrame, ticker: str, level: str, n: int = 4, after: str | None = None
) -> DataFrame:
    """Latest n periods of a ticker at a level, optionally only those after a time key."""
    rows = _of_ticker(rollup, ticker, level)
    if after is not None:
        rows = rows.filter(F.col("TIMESTAMP") > after)
    return rows.orderBy(F.desc("TIMESTAMP")).limit(n)


def compare(
    rollup: DataFrame, first: str, second: str, level: str, days: tuple[dt.date, dt.date] | None = None
) -> DataFrame:
    """Counters of two tickers side by side, one row per period in which either was mentioned.

    `days`, first and last, clip hours and days; longer periods are given whole.
    """
    wanted = [ticker_detail_of(ticker, level) for ticker in (first, second)]
    rows = rollup.filter(F.col("TickerDetail").isin(wanted))
    if days is not None and check_level(level) in ("HOURLY", "DAILY"):
        after = f"{days[1] + dt.timedelta(days=1):%Y-%m-%d}"
        # time keys begin with their day, and as text they still reach the scan
        rows = rows.filter((F.col("TIMESTAMP") >= f"{days[0]:%Y-%m-%d}") & (F.col("TIMESTAMP") < after))
    sums = [
        F.sum(F.when(F.col("TickerDetail") == detail, F.col(c))).alias(f"{c}_{i}")
        for i, detail in enumerate(wanted, 1)
        for c in COUNTERS
    ]
    return rows.groupBy("DetailLevel").agg(*sums)


def all_metrics(metrics: DataFrame) -> DataFrame:
    """The whole metrics table."""
    return metrics


# ---- recent posts --------------------------------------------------------------------------
def recent_table(mentions: DataFrame, n_keys: int = 5, run_id: str | None = None) -> DataFrame:
    """Mentions in the shape of the recent-posts table. Ordering is left to the sink.

    Mentions whose texts are kept apart keep their reference (TEXTS_AT) in place of the texts.
    """
    texts = [F.col("tweet_text_text").alias("TEXT"), F.col("tweet_text_clean").alias("CLEANTEXT")]
    out = mentions.select(
        spread_key("tweet_id", n_keys).alias("PARTITION"),
        time_key("tweet_meta_created_at", "tweet_id").alias("TIMESTAMP"),
        F.col("tweet_id").cast("string").alias("ID"),
        F.col("ticker").alias("TICKER"),
        F.col("tweet_text_sentiment").alias("SENTIMENT"),
        *([TEXTS_AT] if TEXTS_AT in mentions.columns else texts),
    )
    return out if run_id is None else out.withColumn("RUN_ID", F.lit(run_id))


def _newest_first() -> list[Column]:
    # two tickers of one post share a time key
    return [F.desc("TIMESTAMP"), F.desc("TICKER"), F.desc("ID")]


def recent_posts(
    recent: DataFrame,
    n: int = 100,
    start: str | None = None,
    end: str | None = None,
    ticker: str | None = None,
) -> DataFrame:
    """Newest n rows of a time range, over all spread keys; of one ticker if given."""
    rows = in_range(recent, start, end)
    if ticker is not None:
        rows = rows.filter(F.col("TICKER") == ticker.upper())
    return rows.orderBy(*_newest_first()).limit(n)


def recent_then_ticker(
    recent: DataFrame, n: int, ticker: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Of the newest n rows, those of a ticker: limit first, filter second."""
    return recent_posts(recent, n, start, end).filter(F.col("TICKER") == ticker)


def recent_for_ticker(
    recent: DataFrame, n: int, ticker: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The newest n rows of a ticker: filter first, limit second."""
    return recent_posts(recent, n, start, end, ticker)


def recent_per_ticker(recent: DataFrame, n: int = 10) -> DataFrame:
    """The newest n rows of every ticker; each task keeps n rows per ticker before the shuffle."""
    per_ticker = Window.partitionBy("TICKER").orderBy(*_newest_first())
    return recent.withColumn("RANK", F.row_number().over(per_ticker)).filter(F.col("RANK") <= n)


# ---- result sets ---------------------------------------------------------------------------
def class_counts(recent: DataFrame) -> DataFrame:
    """Rows per sentiment."""
    return recent.groupBy("SENTIMENT").agg(F.count(F.lit(1)).alias("n_posts"))


def class_totals(recent: DataFrame) -> DataFrame:
    """Positive, negative and all rows, in one line."""
    return recent.agg(
        F.count_if(F.col("SENTIMENT") == "POSITIVE").alias("n_positive"),
        F.count_if(F.col("SENTIMENT") == "NEGATIVE").alias("n_negative"),
        F.count(F.lit(1)).alias("n_total"),
    )


def ticker_choices(recent: DataFrame) -> DataFrame:
    """Distinct tickers of a result set."""
    return recent.select("TICKER").distinct()


def value_counts(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The n most frequent values of a column; equal counts by value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(column)).limit(n)


def term_counts(df: DataFrame, k: int | None = None, text: str = "CLEANTEXT") -> DataFrame:
    """Frequency of the words of cleaned texts; the k most frequent if k is given."""
    words = df.select(F.explode(F.split(F.lower(F.col(text)), " ")).alias("term"))
    counts = words.filter(F.col("term") != "").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return counts if k is None else counts.orderBy(F.desc("n"), F.asc("term")).limit(k)


def sample_rows(df: DataFrame, n: int = 4) -> DataFrame:
    """Any n rows, to look at."""
    return df.limit(n)
