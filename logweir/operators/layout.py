"""Partition counts, caching and per-partition work."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from logweir.sources.files import list_files


def partitions_for(total_bytes: int, size_mb: int = 128) -> int:
    """Number of tasks of about ``size_mb`` MiB each: whole MiB over size, plus one."""
    return total_bytes // (1024 * 1024) // size_mb + 1


def sized(df: DataFrame, glob: str, size_mb: int = 128) -> DataFrame:
    """``df`` coalesced to the number of tasks the files under ``glob`` call for."""
    total = list_files(df.sparkSession, glob).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    return df.coalesce(partitions_for(total, size_mb))


def relayout(df: DataFrame, n: int | None = None, *cols: str, shuffle: bool = True) -> DataFrame:
    """Repartition to ``n`` parts, or coalesce with ``shuffle=False``.

    Without ``n`` Spark balances the parts by size, splitting a hot key.
    """
    if n is None:
        return df.hint("rebalance", *cols)
    return df.repartition(n, *cols) if shuffle else df.coalesce(n)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` for several actions and release it at the end of the block."""
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def map_batches(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    """Arrow batches of each partition through ``fn``, which runs its setup once per partition."""
    return df.mapInArrow(fn, schema)
