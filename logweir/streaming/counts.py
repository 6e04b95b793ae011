"""Stateful counts over streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType

from logweir.streaming.batches import run_available


def running_counts(stream: DataFrame, key: str) -> DataFrame:
    """Rows per key since the start. Write in ``complete`` mode to get every key in each batch."""
    return stream.groupBy(key).count()


def changed_counts(stream: DataFrame, key: str) -> DataFrame:
    """Rows per key since the start. Write in ``update`` mode to get the keys of the batch only."""
    return stream.groupBy(key).count()


def stateful(
    stream: DataFrame, key: str, amount: str, fn: Callable[[Any, int, int | None], int], out: str = "state"
) -> DataFrame:
    """Custom state per key: ``fn(key, batch_total, old_state)`` gives the new state. Update mode.

    ``old_state`` is None for a new key. Amounts are summed in each task before the shuffle, so a
    hot key reaches its state as a few rows per task. ``fn`` gets whole-number keys as int, others as text.
    """
    kind = stream.schema[key].dataType
    whole = isinstance(kind, IntegralType)

    # Keys travel as text: as pandas numbers a NULL among them would turn them into floats.
    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = pa.Table.from_batches([batch]).group_by("_key").aggregate([("_amount", "sum")])
            yield from sums.rename_columns(["_key", "_amount"]).combine_chunks().to_batches()

    def advance(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total = sum(int(part["_amount"].sum()) for part in parts)
        name = int(group[0]) if whole and group[0] is not None else group[0]
        new = fn(name, total, state.get[0] if state.exists else None)
        state.update((new,))
        yield pd.DataFrame({"_key": [group[0]], out: [new]})

    amounts = stream.select(F.col(key).cast("string").alias("_key"), F.coalesce(F.col(amount).cast("bigint"), F.lit(0)).alias("_amount"))
    states = (
        amounts.mapInArrow(combine, "_key string, _amount long")
        .groupBy("_key")
        .applyInPandasWithState(advance, f"_key string, {out} long", "state bigint", "update", GroupStateTimeout.NoTimeout)
    )
    return states.select(F.col("_key").cast(kind).alias(key), out)


def seeded_counts(stream: DataFrame, seed: DataFrame, key: str, out: str, checkpoint: str, count: str = "count") -> str:
    """Running counts that start from the counts in ``seed``; every key is in each batch of ``out``.

    The seed is written beside the checkpoint when the stream first starts, and read by its first batch only: from
    then on its counts are state like all others. A later start takes no notice of ``seed``.
    """
    spark, path = stream.sparkSession, f"{checkpoint.rstrip('/')}-seed"
    start = seed.select(key, F.col(count).cast("bigint").alias("n"))
    if not _started(spark, checkpoint):
        start.write.mode("overwrite").parquet(path)
    seeds = spark.readStream.schema(start.schema).parquet(path)
    # Once the seed is read, Spark plans without it; keys that it may have NULL must stay nullable then.
    keys = stream.select(F.explode_outer(F.array(key)).alias(key), F.lit(1).cast("bigint").alias("n"))
    counted = keys.unionByName(seeds)
    return run_available(counted.groupBy(key).agg(F.sum("n").alias("count")), out, checkpoint, "complete")


def _started(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a stream with this checkpoint has planned a batch."""
    try:
        spark.read.text(f"{checkpoint.rstrip('/')}/offsets")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def sliding_counts(
    stream: DataFrame,
    ts: str,
    key: str,
    length: str,
    slide: str,
    mode: str = "merged",
    batch: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Rows per key in sliding windows: columns ``start``, ``end``, the key and ``count``.

    ``merged`` sums each window. ``concat`` counts per ``batch`` interval and repeats each such
    count in every window over it, with its ``batch_start``. A ``watermark`` lets old windows go.
    """
    if watermark:
        stream = stream.withWatermark(ts, watermark)
    if mode == "merged":
        counts = stream.groupBy(F.window(ts, length, slide).alias("w"), key).count()
        return counts.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "count")
    if mode != "concat" or batch is None:
        raise ValueError("mode is merged, or concat with a batch interval")
    counts = stream.groupBy(F.window(ts, batch).alias("b"), key).count()
    covering = counts.select(F.col("b.start").alias("batch_start"), key, "count").withColumn(
        "w", F.window("batch_start", length, slide)
    )
    return covering.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "batch_start", key, "count")


def chained_windows(stream: DataFrame, ts: str, key: str, pane: str, length: str, slide: str, watermark: str) -> DataFrame:
    """Rows per key in sliding windows, as sums of counts by pane: ``start``, ``end``, the key and ``count``.

    Write in append mode: a pane is given to the windows over it once the watermark has passed it, and each window is
    given out once, when all its panes are. Rows are counted into one pane each instead of every window over
    them, and what the watermark has passed leaves the state of both counts. ``length`` and ``slide`` are multiples of
    ``pane``. Rows later than the watermark allows, and rows without time, are dropped.
    """
    timed = stream.select(F.col(ts).cast("timestamp").alias("_at"), key).withWatermark("_at", watermark)
    panes = timed.groupBy(F.window("_at", pane).alias("p"), key).agg(F.count("*").alias("n"))
    windows = panes.groupBy(F.window(F.window_time("p"), length, slide).alias("w"), key).agg(F.sum("n").alias("count"))
    return windows.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "count")


def offset_ranges(batch: DataFrame) -> DataFrame:
    """First offset and end offset (exclusive) of each log partition present in a batch."""
    return batch.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )
