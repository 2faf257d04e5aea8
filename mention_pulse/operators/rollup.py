"""Roll-ups at four time levels, their merge over runs, and change against the previous period."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mention_pulse.functions.keys import (
    LEVELS,
    PARTS,
    check_level,
    check_parts,
    detail_level,
    packed_time_key,
    ticker_detail,
    unpack_time_key,
)
from mention_pulse.schemas import COUNTERS

ROLLUP_KEYS = ["DetailLevel", "TICKER", "TickerDetail"]
SENTIMENT, CREATED, POST_ID = "tweet_text_sentiment", "tweet_meta_created_at", "tweet_id"


def class_counters(sentiment: str = SENTIMENT) -> list[Column]:
    """Mentions and mentions per class; a missing class counts as a mention only."""
    per_class = [
        F.count_if(F.col(sentiment) == name).alias(f"NUM_{name}")
        for name in ("POSITIVE", "NEGATIVE", "NEUTRAL")
    ]
    return [F.count(F.lit(1)).alias("NUM_MENTIONS"), *per_class]


def _summed() -> list[Column]:
    return [F.sum(name).alias(name) for name in COUNTERS]


def _with_run(df: DataFrame, run_id: str | None) -> DataFrame:
    return df if run_id is None else df.withColumn("RUN_ID", F.lit(run_id))


def _level_name() -> Column:
    """Level of a grouping set, from how many of its date parts are rolled up."""
    rolled = sum((F.grouping(part) for part in PARTS[2:]), F.grouping(PARTS[1]))
    names = F.array(*(F.lit(name) for name in reversed(list(LEVELS))))
    return F.get(names, rolled.cast("int"))


def hour_partials(mentions: DataFrame) -> DataFrame:
    """Counters and first time key per ticker and hour: all that any level needs.

    Everything here is of fixed width, so it is hash-aggregated before the only shuffle.
    """
    return mentions.groupBy("ticker", *PARTS).agg(
        F.min(packed_time_key(CREATED, POST_ID)).alias("_first"), *class_counters()
    )


def stored_rollup(hours: DataFrame) -> DataFrame:
    """The four levels per ticker with FIRST, the earliest time key as a number, for `merge_stored`."""
    return _levels_of_hours(hours).select("*", unpack_time_key("FIRST").alias("TIMESTAMP"))


def rollup_from_hours(hours: DataFrame, run_id: str | None = None) -> DataFrame:
    """The four levels per ticker, in one pass over the hour partials."""
    levels = _levels_of_hours(hours).withColumn("TIMESTAMP", unpack_time_key("FIRST"))
    return _with_run(levels.select(*ROLLUP_KEYS, "TIMESTAMP", *COUNTERS), run_id)


def merge_stored(rows: DataFrame, run_id: str | None = None) -> DataFrame:
    """Stored roll-ups of several runs as one: sums and the earliest key, hash-aggregated throughout."""
    out = rows.groupBy(*ROLLUP_KEYS).agg(F.min("FIRST").alias("FIRST"), *_summed())
    out = out.withColumn("TIMESTAMP", unpack_time_key("FIRST"))
    return _with_run(out.select(*ROLLUP_KEYS, "TIMESTAMP", *COUNTERS, "FIRST"), run_id)


def _levels_of_hours(hours: DataFrame) -> DataFrame:
    sets = [["ticker", *parts] for parts in LEVELS.values()]
    grouped = hours.groupingSets(sets, "ticker", *PARTS).agg(
        _level_name().alias("LEVEL"), F.min("_first").cast("decimal(38,0)").alias("FIRST"), *_summed()
    )
    return grouped.select(
        detail_level(PARTS).alias("DetailLevel"),
        F.col("ticker").alias("TICKER"),
        ticker_detail("ticker", F.col("LEVEL")).alias("TickerDetail"),
        *COUNTERS,
        "FIRST",
    )


def ticker_rollup(mentions: DataFrame, run_id: str | None = None) -> DataFrame:
    """Per ticker and period, at all four levels: first time key and counters."""
    return rollup_from_hours(hour_partials(mentions), run_id)


def rollup_at(mentions: DataFrame, parts: Sequence[str], level: str) -> DataFrame:
    """Per ticker and period, for one choice of date parts."""
    parts, level = check_parts(parts), check_level(level)
    grouped = mentions.groupBy("ticker", *parts).agg(
        F.min(packed_time_key(CREATED, POST_ID)).alias("_first"), *class_counters()
    )
    return grouped.select(
        detail_level(parts).alias("DetailLevel"),
        F.col("ticker").alias("TICKER"),
        ticker_detail("ticker", level).alias("TickerDetail"),
        unpack_time_key("_first").alias("TIMESTAMP"),
        *COUNTERS,
    )


def _metric_levels(hours: DataFrame) -> DataFrame:
    grouped = hours.groupingSets([list(parts) for parts in LEVELS.values()], *PARTS).agg(
        _level_name().alias("LEVEL"), *_summed()
    )
    return grouped.select(detail_level(PARTS).alias("DetailLevel"), "LEVEL", *COUNTERS)


def metrics_from_hours(hours: DataFrame, run_id: str | None = None) -> DataFrame:
    """The four levels over all tickers, from the same hour partials as the ticker roll-up."""
    return _with_run(_metric_levels(hours), run_id)


def level_metrics(mentions: DataFrame, run_id: str | None = None) -> DataFrame:
    """Per period, at all four levels: counters over all tickers."""
    return metrics_from_hours(mentions.groupBy(*PARTS).agg(*class_counters()), run_id)


def union_all(frames: Sequence[DataFrame], run_id: str) -> DataFrame:
    """Union by name of a list of frames, stamped with the run."""
    if not isinstance(frames, (list, tuple)) or not frames:
        raise ValueError("expecting a list of at least one DataFrame")
    return reduce(DataFrame.unionByName, frames).withColumn("RUN_ID", F.lit(run_id))


def union_runs(current: DataFrame, history: DataFrame, run_id: str) -> DataFrame:
    """Current and earlier rows together, both stamped with the current run."""
    return union_all([current.drop("RUN_ID"), history.drop("RUN_ID")], run_id)


def merge_rollup(current: DataFrame, history: DataFrame, run_id: str) -> DataFrame:
    """Ticker roll-up of both: sums of the counters, the earliest time key."""
    keys = ["DetailLevel", "TICKER", "TickerDetail", "RUN_ID"]
    merged = union_runs(current, history, run_id).groupBy(*keys)
    out = merged.agg(F.min("TIMESTAMP").alias("TIMESTAMP"), *_summed())
    return out.select(*keys[:3], "TIMESTAMP", *COUNTERS, "RUN_ID")


def merge_metrics(current: DataFrame, history: DataFrame, run_id: str) -> DataFrame:
    """Level metrics of both: sums of the counters."""
    keys = ["DetailLevel", "LEVEL", "RUN_ID"]
    out = union_runs(current, history, run_id).groupBy(*keys).agg(*_summed())
    return out.select(*keys[:2], *COUNTERS, "RUN_ID")


def merge_metrics_of(rows: DataFrame) -> DataFrame:
    """Level metrics of several runs as one: sums of the counters."""
    return rows.groupBy("DetailLevel", "LEVEL").agg(*_summed()).select("DetailLevel", "LEVEL", *COUNTERS)


def replace_days(rollup: DataFrame, fresh: DataFrame, days: Sequence[str]) -> DataFrame:
    """Rebuild a ticker roll-up after some days (yyyy-MM-dd) were landed again.

    Hour rows of those days come from `fresh`, all others from `rollup`; the coarser levels are
    summed up anew from the hours, so nothing is counted twice. Where both sides have FIRST, the time
    key as a number, its minimum is taken and kept, and no text is compared.
    """
    packed = "FIRST" in rollup.columns and "FIRST" in fresh.columns
    first = "FIRST" if packed else "TIMESTAMP"
    hourly = F.col("TickerDetail").endswith("_HOURLY")
    day = F.substring("DetailLevel", 1, 10)
    kept = rollup.filter(hourly & ~day.isin(list(days)))
    taken = fresh.filter(hourly & day.isin(list(days)))
    hours = kept.unionByName(taken, allowMissingColumns=True)
    part = F.split("DetailLevel", "-")
    hours = hours.withColumns({name: F.get(part, F.lit(i)) for i, name in enumerate(PARTS)})
    sets = [["TICKER", *parts] for parts in LEVELS.values()]
    grouped = hours.groupingSets(sets, "TICKER", *PARTS).agg(
        _level_name().alias("LEVEL"), F.min(first).alias(first), *_summed()
    )
    if packed:
        grouped = grouped.withColumn("TIMESTAMP", unpack_time_key("FIRST"))
    return grouped.select(
        detail_level(PARTS).alias("DetailLevel"),
        "TICKER",
        ticker_detail("TICKER", F.col("LEVEL")).alias("TickerDetail"),
        "TIMESTAMP",
        *COUNTERS,
        *(["FIRST"] if packed else []),
    )


def metrics_of_rollup(rollup: DataFrame) -> DataFrame:
    """Level metrics as sums of a ticker roll-up over its tickers."""
    level = F.substring_index("TickerDetail", "_", -1)
    out = rollup.groupBy("DetailLevel", level.alias("LEVEL")).agg(*_summed())
    return out.select("DetailLevel", "LEVEL", *COUNTERS)


def with_previous(metrics: DataFrame) -> DataFrame:
    """Add D_*: the counters of the previous present period of the same level, 0 for the first.

    One row per calendar period, so a level's window is bounded by the hours on the calendar.
    """
    newest_first = Window.partitionBy("LEVEL").orderBy(F.desc("DetailLevel"))
    return metrics.withColumns(
        {f"D_{c}": F.coalesce(F.lead(c).over(newest_first), F.lit(0)) for c in COUNTERS}
    )


def metrics_at(metrics: DataFrame, key: str) -> DataFrame:
    """Metrics of one level key."""
    return metrics.filter(F.col("DetailLevel") == key)


def period_change(metrics_with_previous: DataFrame, key: str) -> DataFrame:
    """Counters of one period and their change against the period before."""
    changes = [(F.col(c) - F.col(f"D_{c}")).alias(f"CHANGE_{c}") for c in COUNTERS]
    return metrics_at(metrics_with_previous, key).select("DetailLevel", "LEVEL", *COUNTERS, *changes)
