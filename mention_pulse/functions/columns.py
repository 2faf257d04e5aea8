"""Projection and typing helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten(df: DataFrame) -> DataFrame:
    """One flat select of every leaf, `a.b` becoming `a_b`; arrays stay arrays."""

    def leaves(schema: T.StructType, path: tuple[str, ...] = ()) -> list[Column]:
        out = []
        for field in schema:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                out += leaves(field.dataType, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias("_".join(here)))
        return out

    return df.select(*leaves(df.schema))


def resolve_long(df: DataFrame, name: str) -> Column:
    """A bigint from a column of doubtful type.

    A struct with one field per observed type gives its first non-null field; anything else is
    cast, with null for text that is no number.
    """
    kind = df.schema[name].dataType
    if isinstance(kind, T.StructType):
        return F.coalesce(*(F.col(f"{name}.{f.name}").try_cast("bigint") for f in kind))
    return F.col(name).try_cast("bigint")


def apply_mapping(df: DataFrame, mapping: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Rename and retype by a list of (source, source type, target, target type)."""
    return df.select(*(F.col(src).cast(kind).alias(dst) for src, _, dst, kind in mapping))


def to_epoch(ts: Column | str) -> Column:
    """UTC epoch seconds, as double, of a timestamp (a zone-less one is taken as UTC)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def epoch_micros(epoch: Column | str) -> Column:
    """Whole microseconds of an epoch in seconds; rounding undoes the float error of `to_epoch`."""
    epoch = F.col(epoch) if isinstance(epoch, str) else epoch
    return F.round(epoch * F.lit(1e6)).cast("bigint")


def to_ts(epoch: Column | str) -> Column:
    """Timestamp of an epoch in seconds."""
    return F.timestamp_micros(epoch_micros(epoch))


def with_date_parts(df: DataFrame, created_at: str) -> DataFrame:
    """Add zero-padded text columns year, month, day, hour unless the frame has them already."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    ts = to_ts(created_at)
    return df.withColumns(
        {name: F.date_format(ts, fmt) for name, fmt in parts.items() if name not in df.columns}
    )


def with_original_flag(df: DataFrame, parent_type: str = "reference_tweets_tweet_type") -> DataFrame:
    """`is_original`: no parent was resolved (a reply to a lost post is 'original' too)."""
    return df.withColumn("is_original", F.col(parent_type).isNull())


def post_type(refs: Column | str) -> Column:
    """'original' without a reference, else the type of the first one."""
    refs = F.col(refs) if isinstance(refs, str) else refs
    return F.coalesce(F.get(refs, F.lit(0)).getField("type"), F.lit("original"))
