"""File sinks. Partitioned writes are dealt by folder first, so each folder gets few, even files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, functions as F


def write_text(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists") -> None:
    """Rows as lines of text; NULL shows as ``null``."""
    cells = (F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns)
    df.select(F.concat_ws(sep, *cells).alias("value")).write.mode(mode).text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


SMALL_BYTES = 1 << 30


def _foldered(df: DataFrame, by: Sequence[str]) -> DataFrameWriter:
    """Writer whose tasks each hold whole folders, a folder too large for one task being split.

    Balancing by size would leave small inputs, and all their folders, to one task. So an input that Spark estimates
    at less than ``SMALL_BYTES`` is dealt by folder to as many tasks as there are cores.
    """
    if estimated_bytes(df) < SMALL_BYTES:
        df = df.repartition(df.sparkSession.sparkContext.defaultParallelism, *by)
    else:
        df = df.hint("rebalance", *by)
    return df.write.partitionBy(*by)


def estimated_bytes(df: DataFrame) -> int:
    """Spark's estimate of the size of ``df`` from the files below it; nothing is run."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def write_partitioned(df: DataFrame, path: str, *by: str, mode: str = "errorifexists") -> None:
    """Parquet in one folder per value of ``by``."""
    _foldered(df, by).mode(mode).parquet(path)


def write_day_hour(df: DataFrame, path: str, batch: str | None = None, gather: bool = True) -> None:
    """Uncompressed Parquet by ``day`` and ``hour``; a batch can be written again.

    With a ``batch`` name its rows go to ``batch=<name>`` under ``path`` and replace what an earlier
    run of the same batch left, rows of other batches for the same hour staying. Without one the
    days and hours present in ``df`` are replaced and the others kept.
    ``gather=False`` saves the shuffle where the input files hold few hours each.
    """
    by = ["day", "hour"]
    target = path if batch is None else f"{path}/batch={batch}"
    options = {"compression": "none", "partitionOverwriteMode": "dynamic" if batch is None else "static"}
    if not gather:
        df.write.mode("overwrite").partitionBy(*by).options(**options).parquet(target)
        return
    _foldered(df, by).mode("overwrite").options(**options).parquet(target)
