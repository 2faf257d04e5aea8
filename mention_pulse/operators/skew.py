"""Joins that survive a key holding a large part of all rows, and checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key above HOT_ROWS is cut into slices of about that many rows. At most MAX_HOT_KEYS keys (the
# largest) are treated so, which bounds the broadcast marker table to a few megabytes; the join is
# exact for all other keys too, and none of them can hold more than 1 / MAX_HOT_KEYS of the rows.
HOT_ROWS = 500_000
MAX_HOT_KEYS = 100_000
NULL_SLICES = 65_536
# Largest dimension, in rows, that is broadcast, and that is put into a query as literals.
MAX_DIM_ROWS = 50_000
MAX_LITERALS = 10_000


def is_small(df: DataFrame, max_rows: int = MAX_DIM_ROWS) -> bool:
    """Whether a dimension has at most `max_rows` rows (runs a job which stops at the limit)."""
    return df.limit(max_rows + 1).count() <= max_rows


def small_values(df: DataFrame, column: str, max_rows: int = MAX_LITERALS) -> list | None:
    """Values of a dimension column for use as literals, or None if there are too many.

    Runs a job that stops one row above the limit; nothing larger reaches the driver.
    """
    rows = df.select(column).limit(max_rows + 1).collect()
    return [row[0] for row in rows] if len(rows) <= max_rows else None


def hot_keys(counts: DataFrame, key: str, n: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(key, _slices) of the largest keys above `hot_rows`, from a frame of counts per key."""
    return (
        counts.filter(F.col(n) > hot_rows)
        .orderBy(F.desc(n), key)
        .limit(MAX_HOT_KEYS)
        .select(F.col(key).alias("_hot"), F.ceil(F.col(n) / F.lit(hot_rows)).cast("int").alias("_slices"))
    )


def slice_rows(df: DataFrame, key: str, spread_by: Column | str, hot: DataFrame) -> DataFrame:
    """Add `_slice`: rows of a hot key are dealt over its slices, all others get 0.

    Rows with a null key match nothing but would still meet in one task, so they are dealt too.
    """
    spread_by = F.col(spread_by) if isinstance(spread_by, str) else spread_by
    slices = F.when(F.col(key).isNull(), F.lit(NULL_SLICES)).otherwise(F.col("_slices"))
    dealt = F.pmod(F.xxhash64(spread_by), slices).cast("int")
    return (
        df.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
        .withColumn("_slice", F.coalesce(dealt, F.lit(0)))
        .drop("_hot", "_slices")
    )


def copy_to_slices(df: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """Add `_slice` to a side with one row per key: a hot key gets one copy per slice."""
    last = F.coalesce(F.col("_slices"), F.lit(1)) - F.lit(1)
    return (
        df.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), last)))
        .drop("_hot", "_slices")
    )


def join_dimension(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    dim_key: str,
    spread_by: str,
    how: str = "inner",
    max_rows: int = MAX_DIM_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join rows to a dimension with one row per key, keeping all columns of both.

    A dimension of checked size is broadcast. A larger one is joined by shuffle, with the rows of
    frequent keys cut into slices; a stream, whose keys cannot be counted, is joined as it is.
    """
    same = F.col(key) == F.col(dim_key)
    if is_small(dim, max_rows):
        return df.join(F.broadcast(dim), same, how)
    if df.isStreaming:
        return df.join(dim, same, how)
    hot = hot_keys(df.groupBy(key).agg(F.count(key).alias("_n")), key, "_n", hot_rows)
    left = slice_rows(df, key, spread_by, hot)
    right = copy_to_slices(dim, dim_key, hot).withColumnRenamed("_slice", "_copy")
    joined = left.join(right, same & (F.col("_slice") == F.col("_copy")), how)
    return joined.drop("_slice", "_copy")
