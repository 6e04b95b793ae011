"""Projections and filters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from logweir.functions.text import split_java


def project(df: DataFrame, *cols: Column | str) -> DataFrame:
    return df.select(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def with_expr(df: DataFrame, name: str, expr: Column) -> DataFrame:
    return df.withColumn(name, expr)


def format_row(template: str, *cols: Column | str) -> Column:
    """Text from a ``{}`` template, such as ``Key: {}, Value: {}``; a NULL value shows as ``null``."""
    parts = template.split("{}")
    if len(parts) != len(cols) + 1:
        raise ValueError(f"{template!r} has {len(parts) - 1} slots for {len(cols)} columns")
    pieces = [F.lit(parts[0])]
    for col, tail in zip(cols, parts[1:]):
        col = F.col(col) if isinstance(col, str) else col
        pieces += [F.coalesce(col.cast("string"), F.lit("null")), F.lit(tail)]
    return F.concat(*pieces)


def split_fields(df: DataFrame, sep: str, col: str = "value", out: str = "fields") -> DataFrame:
    """Replace a text column by the array of its fields."""
    return df.withColumn(out, split_java(F.col(col), sep)).drop(col)


def pick_fields(df: DataFrame, arr: str, spec: Mapping[str, int]) -> DataFrame:
    """Named columns by position; a missing position fails the job, so filter on arity first."""
    return df.select(*(F.col(arr)[position].alias(name) for name, position in spec.items()))


def where(df: DataFrame, cond: Column | str) -> DataFrame:
    return df.filter(cond)


def where_arity(df: DataFrame, arr: str, n: int) -> DataFrame:
    """Rows whose array has exactly ``n`` fields."""
    return df.filter(F.size(arr) == n)
