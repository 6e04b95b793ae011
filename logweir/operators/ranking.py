"""Sorting, top-N per group and first or last value of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def ranked(df: DataFrame, order: Sequence[Column | str], limit: int | None = None) -> DataFrame:
    """Global sort, or the first ``limit`` rows of it."""
    out = df.orderBy(*order)
    return out if limit is None else out.limit(limit)


def top_n(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank_col: str = "rank",
    splits: int | None = None,
    falling: str | None = None,
) -> DataFrame:
    """First ``n`` rows of each group with their position.

    Spark keeps ``n`` rows per group in every task before the shuffle, for ``n`` within its
    ``spark.sql.optimizer.windowGroupLimitThreshold``. Beyond that, and if ``order`` starts with the numeric column
    ``falling`` from the largest to the least, rows below a cutoff of each group are dropped before the shuffle, see
    ``pruned_top_n``. Any other order cuts each group to ``n`` rows in each of ``splits`` parts first, eight for each
    core unless given, so that no task sorts a whole hot group. Parts are dealt by position, which also splits equal rows.
    Add a tie-break to ``order`` for repeatable results.
    """
    if splits is None:
        threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
        if n > threshold and falling is not None:
            from logweir.operators.sketches import pruned_top_n  # it falls back on this function

            return pruned_top_n(df, by, falling, n, order[1:], rank_col)
        splits = 1 if n <= threshold else 8 * df.sparkSession.sparkContext.defaultParallelism
    if splits > 1:
        parted = df.withColumn("_part", F.monotonically_increasing_id() % splits)
        df = _ranked_within(parted, [*by, "_part"], order, n, "_cut").drop("_part", "_cut")
    return _ranked_within(df, by, order, n, rank_col)


def _ranked_within(df, by, order, n, rank_col) -> DataFrame:
    position = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn(rank_col, position).filter(F.col(rank_col) <= n)


def first_value(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, out: str = "first_value"
) -> DataFrame:
    """Every row with the value of the first row of its group, in ascending ``order``."""
    return _edge_value(df, by, order, value, out, F.min_by)


def last_value(
    df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, out: str = "last_value"
) -> DataFrame:
    """Every row with the value of the last row of its group, in ascending ``order``."""
    return _edge_value(df, by, order, value, out, F.max_by)


def _edge_value(df, by, order, value, out, pick) -> DataFrame:
    # One value per group, joined back: the aggregate merges before its shuffle and AQE can split
    # a hot group in the join, where a window would sort the whole group in one task.
    keys = {name: f"_by_{name}" for name in by}
    edge = df.groupBy(*(F.col(name).alias(alias) for name, alias in keys.items())).agg(
        pick(F.struct(value), F.struct(*order)).alias("_edge")
    )
    same = [F.col(name).eqNullSafe(F.col(alias)) for name, alias in keys.items()]
    return df.join(edge, same).select(*(df[c] for c in df.columns), F.col("_edge")[value].alias(out))
