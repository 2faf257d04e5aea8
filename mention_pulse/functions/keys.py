"""Time, level and spread keys of the serving tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from mention_pulse.functions.columns import epoch_micros, to_ts

PARTS = ("year", "month", "day", "hour")
LEVELS = {"YEARLY": PARTS[:1], "MONTHLY": PARTS[:2], "DAILY": PARTS[:3], "HOURLY": PARTS[:4]}
LEVEL_FORMATS = {
    "YEARLY": "yyyy",
    "MONTHLY": "yyyy-MM",
    "DAILY": "yyyy-MM-dd",
    "HOURLY": "yyyy-MM-dd-HH",
}


def check_parts(parts: Iterable[str]) -> list[str]:
    """The grouping columns, or KeyError when one is no date part."""
    parts = list(parts)
    for part in parts:
        if part not in PARTS:
            raise KeyError(f"{part!r} is none of {PARTS}")
    return parts


def check_level(level: str) -> str:
    """The upper-case level name, or KeyError."""
    if level.upper() not in LEVELS:
        raise KeyError(f"{level!r} is none of {tuple(LEVELS)}")
    return level.upper()


def detail_level(parts: Iterable[str]) -> Column:
    """Level key such as 2022-11-30-05; absent (null) parts are left out."""
    return F.concat_ws("-", *check_parts(parts))


def level_key(level: str, when: dt.date | Column, hour: int | None = None) -> str | Column:
    """Level key of a user's choice: of a date and an hour (text), or of a timestamp column."""
    level = check_level(level)
    if isinstance(when, Column):
        return F.date_format(when, LEVEL_FORMATS[level])
    pieces = [f"{when:%Y}", f"{when:%m}", f"{when:%d}", f"{hour or 0:02d}"]
    return "-".join(pieces[: len(LEVELS[level])])


def ticker_detail(ticker: Column | str, level: Column | str) -> Column:
    """AAPL_HOURLY."""
    level = F.lit(level) if isinstance(level, str) else level
    ticker = F.col(ticker) if isinstance(ticker, str) else ticker
    return F.concat(ticker, F.lit("_"), F.upper(level))


def _id_suffix(post_id: Column | str) -> Column:
    post_id = F.col(post_id) if isinstance(post_id, str) else post_id
    return F.substring(post_id.cast("string"), -10, 10)


def time_key(created_at: Column | str, post_id: Column | str) -> Column:
    """Sort key unique per post: timestamp text, a dot, the last ten digits of the id."""
    return F.concat(to_ts(created_at).cast("string"), F.lit("."), _id_suffix(post_id))


def key_ts(key: Column | str) -> Column:
    """Timestamp (whole seconds) of a time key: what stands before its first dot."""
    return F.to_timestamp(F.substring_index(key, ".", 1), "yyyy-MM-dd HH:mm:ss")


def spread_key(post_id: Column | str, n: int) -> Column:
    """id modulo n as text; spreads recent posts over n keys."""
    post_id = F.col(post_id) if isinstance(post_id, str) else post_id
    return (post_id.cast("bigint") % F.lit(n)).cast("string")


# --- time keys as numbers -------------------------------------------------------------------
# min() of a text column makes Spark sort every input row (SortAggregate); min() of a decimal
# stays in a hash aggregate. So roll-ups take the minimum of a decimal which orders exactly as
# the text of `time_key` does, and turn one value per group back into text.
#
# The text is <19-char second> then either .<id> or .<fraction>.<id>. A dot sorts before any
# digit, so texts of one second compare by the first digit run (zero-padded, then the shorter
# first), then whole seconds before fractions, then the id behind the fraction.
#   decimal = second(12 digits) | run(10) length(2) has_fraction(1) | id(10) length(2)
_EPOCH_SHIFT = 62_135_596_800  # seconds from year 1 to 1970: keeps every part non-negative
_HEAD, _TAIL = 10**13, 10**12


def _run_code(digits: Column) -> Column:
    return F.rpad(digits, 10, "0").cast("bigint") * F.lit(100) + F.length(digits)


def packed_time_key(created_at: Column | str, post_id: Column | str) -> Column:
    """Decimal with the order of `time_key`, for ids that are not negative."""
    ident = (F.col(post_id) if isinstance(post_id, str) else post_id).cast("bigint")
    micros = epoch_micros(created_at)
    fraction = F.pmod(micros, F.lit(1_000_000))
    second = ((micros - fraction) / F.lit(1_000_000)).cast("bigint") + F.lit(_EPOCH_SHIFT)
    # ids of ten digits and more, the usual case, need no text at all
    id_code = F.when(
        ident >= F.lit(10**9),
        F.when(ident < F.lit(10**10), ident).otherwise(ident % F.lit(10**10)) * F.lit(100) + F.lit(10),
    ).otherwise(_run_code(ident.cast("string")))
    frac_code = _run_code(F.rtrim(F.lpad(fraction.cast("string"), 6, "0"), F.lit("0")))
    whole = fraction == F.lit(0)
    head = F.when(whole, id_code * F.lit(10)).otherwise(frac_code * F.lit(10) + F.lit(1))
    tail = F.when(whole, F.lit(0).cast("bigint")).otherwise(id_code)
    return (
        second.cast("decimal(12,0)") * F.lit(_HEAD).cast("decimal(14,0)") + head.cast("decimal(13,0)")
    ).cast("decimal(25,0)") * F.lit(_TAIL).cast("decimal(13,0)") + tail.cast("decimal(12,0)")


def unpack_time_key(packed: Column | str) -> Column:
    """The text of a packed time key."""
    packed = F.col(packed) if isinstance(packed, str) else packed
    digits = F.lpad(packed.cast("string"), 37, "0")

    def part(start: int, size: int) -> Column:
        return F.substring(digits, start, size)

    def run(start: int) -> Column:
        return F.substring(part(start, 10), F.lit(1), part(start + 10, 2).cast("int"))

    second = F.timestamp_seconds(part(1, 12).cast("bigint") - F.lit(_EPOCH_SHIFT)).cast("string")
    tail = F.when(part(25, 1) == "1", F.concat(F.lit("."), run(26))).otherwise(F.lit(""))
    return F.concat(second, F.lit("."), run(13), tail)
