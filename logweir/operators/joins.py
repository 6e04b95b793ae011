"""Joins. Hints are given only by the caller or after a size check; else Catalyst and AQE choose."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructField, StructType, VariantType

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

_STRATEGIES = {"merge", "shuffle_hash"}


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is within both bounds, found by one aggregation over it.

    Spark's own estimate of a joined or filtered table can be far off, this is exact.
    """
    widths = [_width(field) for field in df.schema]
    row_width = reduce(Column.__add__, widths, F.lit(0).cast("bigint"))
    rows, size = df.agg(F.count("*"), F.coalesce(F.sum(row_width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def _width(field: StructField) -> Column:
    """Bytes of a column in one row."""
    name = f"`{field.name}`"
    if isinstance(field.dataType, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 8
    if isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0))
    return F.lit(8)


LOCAL_ROWS = 5_000
LOCAL_ROW_BYTES = 8 * 1024


def local_copy(df: DataFrame) -> DataFrame | None:
    """``df`` as rows held by the driver, if it has at most ``LOCAL_ROWS`` of ``LOCAL_ROW_BYTES`` each; else None.

    Reads no more partitions of ``df`` than it takes to see that there are more rows.
    """
    if any(isinstance(f.dataType, VariantType) for f in df.schema):
        return None
    width = reduce(Column.__add__, (_width(f) for f in df.schema), F.lit(0).cast("bigint"))
    row = F.when(width <= LOCAL_ROW_BYTES, F.struct(*(F.col(f"`{c}`") for c in df.columns)))
    head = df.select(row.alias("row")).take(LOCAL_ROWS + 1)
    if len(head) > LOCAL_ROWS or any(r.row is None for r in head):
        return None
    return df.sparkSession.createDataFrame([tuple(r.row) for r in head], df.schema)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast when it is small, else unchanged.

    A handful of rows is fetched once and kept, so that its plan doesn't run again in the join; beyond that the plan
    runs once to be counted.
    """
    if (max_rows, max_bytes) == (BROADCAST_ROWS, BROADCAST_BYTES):
        copy = local_copy(df)
        if copy is not None:
            return F.broadcast(copy)
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def join_on(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    how: str = "inner",
    strategy: str | None = None,
    salt: int | None = None,
) -> DataFrame:
    """Equi-join on pairs of (left, right) columns; both key columns stay in the result.

    ``strategy`` asks for a shuffled join (``merge`` or ``shuffle_hash``). ``salt`` spreads each
    key of ``left`` over that many partitions and repeats ``right`` as often, for a known hot key
    on the left of an inner or left join; salts go by position, so equal rows are spread too. AQE
    splits skewed partitions without it.
    """
    if strategy is not None:
        if strategy not in _STRATEGIES:
            raise ValueError(f"strategy must be one of {sorted(_STRATEGIES)}")
        right = right.hint(strategy)
    cond = [left[a] == right[b] for a, b in keys]
    if salt:
        if how not in ("inner", "left"):
            raise ValueError("salt needs an inner or left join")
        left = left.withColumn("_salt_l", (F.monotonically_increasing_id() % salt).cast("int"))
        right = right.withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        cond = [left[a] == right[b] for a, b in keys] + [left["_salt_l"] == right["_salt_r"]]
    joined = left.join(right, cond, how)
    return joined.drop("_salt_l", "_salt_r") if salt else joined


def lookup_join(big: DataFrame, small: DataFrame, key: str, dedupe_small_by: Column | None = None) -> DataFrame:
    """Inner join with a lookup table, broadcast when it is small enough.

    With ``dedupe_small_by`` only the row with the largest value of it is kept for each key.
    """
    if dedupe_small_by is not None:
        rest = F.struct(*(c for c in small.columns if c != key))
        small = small.groupBy(key).agg(F.max_by(rest, dedupe_small_by).alias("_row")).select(key, "_row.*")
    return big.join(broadcast_if_small(small), key)


def flag_join(df: DataFrame, flags: DataFrame, key: str, flag: str = "flag") -> DataFrame:
    """Left join with a flag list; keys not listed get ``false``."""
    return df.join(flags.select(key, flag), key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def blocklist(df: DataFrame, listed: DataFrame, key: str, flag: str | None = None) -> DataFrame:
    """Rows whose key is not listed (with ``flag``: not listed as true); NULL keys are kept.

    ``df`` may be a stream.
    """
    return df.join(_listed(listed, key, flag), key, "left_anti")


def allowlist(df: DataFrame, listed: DataFrame, key: str, flag: str | None = None) -> DataFrame:
    """Rows whose key is listed. ``df`` may be a stream."""
    return df.join(_listed(listed, key, flag), key, "left_semi")


def _listed(listed: DataFrame, key: str, flag: str | None) -> DataFrame:
    return (listed.filter(flag) if flag else listed).select(key)
