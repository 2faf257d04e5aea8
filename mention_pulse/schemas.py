"""Declared schemas: nothing is inferred, so a stray value cannot retype a column."""

from __future__ import annotations

from pyspark.sql import types as T

_STR, _LONG, _DBL, _BOOL = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


POST_META = _struct(
    created_at=_DBL, tweet_type=_STR, sensitive=_BOOL, hashcashtags=T.ArrayType(_STR)
)

# The parent's id is text: some producers send a non-numeric id (see functions.columns.resolve_long).
PARENT = _struct(tweet_id=_STR, tweet_type=_STR, text=_STR, hashcashtags=T.ArrayType(_STR))

POSTS_RAW = _struct(
    tweet_id=_LONG, author_id=_LONG, text=_STR, tweet_meta=POST_META, reference_tweets=PARENT
)

SCORED_TEXT = _struct(text=_STR, sentiment=_STR, total=_DBL, positive=_DBL, negative=_DBL)

PARENT_SCORED = _struct(
    tweet_id=_STR, tweet_type=_STR, hashcashtags=T.ArrayType(_STR), tweet_text=SCORED_TEXT
)

POSTS_SCORED = _struct(
    tweet_id=_LONG,
    author_id=_LONG,
    tweet_meta=POST_META,
    reference_tweets=PARENT_SCORED,
    tweet_text=SCORED_TEXT,
)

RECORDS = _struct(recordId=_STR, approximateArrivalTimestamp=_LONG, data=_STR)

TICKERS_CSV = _struct(sno=T.IntegerType(), ticker=_STR, ticker_name=_STR, weight=_DBL)

COUNTERS = ("NUM_MENTIONS", "NUM_POSITIVE", "NUM_NEGATIVE", "NUM_NEUTRAL")

TICKER_ROLLUP = _struct(
    DetailLevel=_STR,
    TICKER=_STR,
    TickerDetail=_STR,
    TIMESTAMP=_STR,
    **{name: _LONG for name in COUNTERS},
    RUN_ID=_STR,
)

# As it is kept: FIRST is the earliest time key as a number, see functions.keys.packed_time_key.
TICKER_ROLLUP_KEPT = T.StructType(
    [*TICKER_ROLLUP.fields[:-1], T.StructField("FIRST", T.DecimalType(38, 0)), TICKER_ROLLUP.fields[-1]]
)

RECENT_POSTS = _struct(
    PARTITION=_STR,
    TIMESTAMP=_STR,
    ID=_STR,
    TICKER=_STR,
    SENTIMENT=_STR,
    TEXT=_STR,
    CLEANTEXT=_STR,
    RUN_ID=_STR,
)

# Where the texts of a row lie that are kept apart from it, see sources.tables.put_texts.
TEXTS_AT = "_texts_at"
TEXTS_REF = T.StructField(TEXTS_AT, _struct(file=_STR, at=_LONG, size=T.IntegerType()))

# As they are kept: without texts where they have a reference.
RECENT_POSTS_KEPT = T.StructType([*RECENT_POSTS.fields, TEXTS_REF])

LEVEL_METRICS = _struct(
    DetailLevel=_STR, LEVEL=_STR, **{name: _LONG for name in COUNTERS}, RUN_ID=_STR
)

# Logical keys of the serving tables, used by the upsert.
TABLE_KEYS = {
    "ticker_rollup": ["DetailLevel", "TICKER"],
    "recent_posts": ["PARTITION", "TIMESTAMP", "TICKER"],
    "level_metrics": ["DetailLevel"],
}
