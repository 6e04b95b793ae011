"""Number parsing and means."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_WHOLE_NUMBER = r"\A[+-]?[0-9]+\z"


def _whole(col: Column, type_: str) -> Column:
    return F.when(col.rlike(_WHOLE_NUMBER), col.try_cast(type_))


def safe_long(col: Column, default: int = 0) -> Column:
    """BIGINT of a string of digits; ``default`` for anything else, blanks around digits included."""
    return F.coalesce(_whole(col, "bigint"), F.lit(default).cast("bigint"))


def safe_int(col: Column) -> Column:
    """INT of a string of digits, NULL for anything else."""
    return _whole(col, "int")


def safe_double(col: Column, default: float = 0.0) -> Column:
    """DOUBLE of a string, ``default`` when it is missing or not a number."""
    return F.coalesce(col.try_cast("double"), F.lit(default))


def strict(col: Column, type_: str) -> Column:
    """Cast that fails the job on bad input (ANSI mode)."""
    return col.cast(type_)


def int_mean(col: Column | str) -> Column:
    """Sum over count, truncated to a whole number; NULL for no rows."""
    col = F.col(col) if isinstance(col, str) else col
    total, rows = F.sum(col.cast("bigint")), F.count(col)
    return F.call_function("div", total, F.nullif(rows, F.lit(0)))


def average(col: Column | str) -> Column:
    """Mean that skips NULL and gives NaN for no values; merges partial sums before the shuffle.

    Values are summed as DOUBLE, so large whole numbers don't overflow.
    """
    col = F.col(col) if isinstance(col, str) else col
    total, rows = F.sum(col.cast("double")), F.count(col)
    return F.when(rows == 0, F.lit(float("nan"))).otherwise(total / F.nullif(rows, F.lit(0)))
