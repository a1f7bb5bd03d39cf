"""Scalar functions on packed ``yyyyMMddHHmm`` times (``pt_d``, ``e_et``).

All are built-in Spark expressions, so they stay inside whole-stage code generation; the reference's
per-row ``apply(lambda)`` needs no Python UDF here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PACKED_FORMAT = "yyyyMMddHHmm"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pack_time(ts) -> Column:
    """Timestamp -> 12-digit ``yyyyMMddHHmm`` long, by arithmetic (no string formatting)."""
    ts = _c(ts)
    return (F.year(ts).cast("long") * 100000000 + F.month(ts).cast("long") * 1000000
            + F.dayofmonth(ts).cast("long") * 10000 + F.hour(ts).cast("long") * 100
            + F.minute(ts).cast("long"))


def slice_part(packed, start: int, length: int = 2) -> Column:
    """Digits ``[start, start+length)`` of the packed value read as text (0-based like a slice)."""
    return F.substring(_c(packed).cast("string"), start + 1, length).cast("int")


def time_parts_slice(df: DataFrame, col: str = "pt_d") -> DataFrame:
    """month, day, hour, minu by slicing the decimal text (F1)."""
    return df.withColumns({
        "month": slice_part(col, 4),
        "day": slice_part(col, 6),
        "hour": slice_part(col, 8),
        "minu": slice_part(col, 10),
    })


def minute_ordinal(day="day", hour="hour", minu="minu") -> Column:
    """``day*1440 + hour*60 + minu`` (F2). Ignores month and year, so it wraps at month end."""
    return _c(day) * 1440 + _c(hour) * 60 + _c(minu)


def epoch_minute(packed) -> Column:
    """Minutes since the epoch: a gap measure that does not wrap at month end."""
    return F.floor(F.unix_timestamp(parse_packed_time(packed).cast("timestamp")) / 60).cast("long")


def with_minute_ordinal(df: DataFrame, col: str = "pt_d", out: str = "date", mode: str = "reference") -> DataFrame:
    """Time parts plus the minute ordinal used by the gap features.

    ``mode="reference"`` reproduces ``day*1440+hour*60+minu``; ``mode="epoch"`` uses epoch minutes.
    """
    df = time_parts_slice(df, col)
    if mode == "epoch":
        return df.withColumn(out, epoch_minute(col))
    return df.withColumn(out, minute_ordinal())


def time_parts_arith(packed) -> dict[str, Column]:
    """year, month, day, hour, minute by integer division and modulo."""
    p = _c(packed).cast("long")
    return {
        "year": F.floor(p / 100000000).cast("int"),
        "month": F.floor((p % 100000000) / 1000000).cast("int"),
        "day": F.floor((p % 1000000) / 10000).cast("int"),
        "hour": F.floor((p % 10000) / 100).cast("int"),
        "minute": (p % 100).cast("int"),
    }


def parse_packed_time(packed) -> Column:
    """Packed long -> ``timestamp_ntz``."""
    return F.to_timestamp_ntz(_c(packed).cast("string"), F.lit(PACKED_FORMAT))


def calendar_parts(ts) -> dict[str, Column]:
    """year, month, day, weekday (Monday=0), hour of a timestamp."""
    ts = _c(ts)
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "weekday": F.weekday(ts),
        "hour": F.hour(ts),
    }


def safe_cast(c, to: str) -> Column:
    """Cast that yields null instead of failing when the value does not fit."""
    return _c(c).try_cast(to)
