"""Time strings. Zone-dependent functions follow the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The default hour, the accepted and the compact time format.
DEFAULT_HOUR = "1901010101"
SOURCE_FORMAT = "yyyy-MM-dd HH:mm:ss"
COMPACT_FORMAT = "yyyyMMddHHmmss"

# Unpadded fields of any length, blanks before a field and trailing text are accepted, and fields may overflow.
_LENIENT = r"^\s*(\d+)-\s*(\d+)-\s*(\d+) \s*(\d+):\s*(\d+):\s*(\d+)"
# Largest year, month and other field with which the time still fits; a larger one can't be read.
_LARGEST = (200_000, 600_000, 1_000_000_000)


def hour_bucket(ts: Column, default: str = DEFAULT_HOUR) -> Column:
    """First ten characters (``yyyyMMddHH``); ``default`` for shorter or NULL text."""
    return F.when(F.length(ts) >= 10, F.substring(ts, 1, 10)).otherwise(F.lit(default))


def bracket_time(col: Column) -> Column:
    """``[20190101010101 +0800]`` to ``20190101010101``: drops the first and last seven characters."""
    return F.when(F.length(col) >= 8, F.substring(col, F.lit(2), F.length(col) - 8))


def _lenient_millis(col: Column) -> Column:
    def field(i: int) -> Column:
        value = F.regexp_extract(col, _LENIENT, i).try_cast("bigint")
        return F.when(value <= _LARGEST[min(i, 3) - 1], value)

    first = F.make_date(field(1).cast("int"), F.lit(1), F.lit(1))
    month = F.add_months(first, (field(2) - 1).cast("int"))
    seconds = (((field(3) - 1) * 24 + field(4)) * 60 + field(5)) * 60 + field(6)
    return F.when(col.rlike(_LENIENT), F.unix_millis(month.cast("timestamp")) + seconds * 1000)


def epoch_millis(col: Column) -> Column:
    """Milliseconds since 1970 of ``yyyy-MM-dd HH:mm:ss`` text, 0 when it cannot be read."""
    exact = F.unix_millis(F.try_to_timestamp(col, F.lit(SOURCE_FORMAT)))
    return F.coalesce(exact, _lenient_millis(col), F.lit(0).cast("bigint"))


def compact_millis(millis: Column) -> Column:
    """``yyyyMMddHHmmss`` form of milliseconds since 1970."""
    return F.date_format(F.timestamp_millis(millis), COMPACT_FORMAT)


def compact_time(col: Column) -> Column:
    """``yyyyMMddHHmmss`` form of a time string; unreadable text gives the epoch."""
    return compact_millis(epoch_millis(col))


def day_of(compact: Column) -> Column:
    """Day ``yyyyMMdd`` of a compact time."""
    return F.substring(compact, 1, 8)


def hour_of(compact: Column) -> Column:
    """Hour ``HH`` of a compact time."""
    return F.substring(compact, 9, 2)
