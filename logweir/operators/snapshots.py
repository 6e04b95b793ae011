"""Row edits as new snapshots of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def append_rows(base: DataFrame, rows: DataFrame) -> DataFrame:
    """All rows of both, columns matched by name."""
    return base.unionByName(rows)


def update_where(df: DataFrame, cond: Column, sets: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows for which ``cond`` is true; all values see the old row."""
    return df.withColumns({name: F.when(cond, value).otherwise(F.col(name)) for name, value in sets.items()})


def delete_where(df: DataFrame, cond: Column | None = None) -> DataFrame:
    """Rows for which ``cond`` is not true (false or NULL); no rows at all without ``cond``."""
    if cond is None:
        return df.filter(F.lit(False))
    return df.filter(~F.coalesce(cond, F.lit(False)))


def upsert(base: DataFrame, changes: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Rows of ``changes`` in place of the rows of ``base`` with the same keys, others added.

    Of several changes for a key the one with the largest ``order`` counts; without that column two changes for a key
    fail the job. Columns that ``changes`` lacks keep their old value, or are NULL on added rows; those that ``base``
    lacks are left out. One full outer join, so ``base`` is read once. A NULL key equals no other.
    """
    keys = list(keys)
    changed = [c for c in base.columns if c in changes.columns and c not in keys]
    new = F.struct(F.lit(True).alias("_is"), *changed)
    if order is not None:
        latest = F.max_by(new, order)
    else:
        once = F.assert_true(F.count("*") == 1, "several changes for one key")
        latest = F.when(once.isNull(), F.first(new))
    edits = changes.groupBy(*keys).agg(latest.alias("_new"))
    whole = base.join(edits, keys, "full_outer")
    return whole.select(
        *(F.when(F.col("_new").isNotNull(), F.col("_new")[c]).otherwise(base[c]).alias(c) if c in changed else F.col(c) for c in base.columns)
    )


def swap_snapshot(df: DataFrame, table: str, path: str) -> None:
    """Write ``df`` to a new folder and point ``table`` at it, so its old files stay readable."""
    df.write.mode("errorifexists").parquet(path)
    spark = df.sparkSession
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
