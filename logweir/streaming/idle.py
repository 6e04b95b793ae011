"""Totals by key that start from a seed and expire with idleness, as value state with event-time timers.

A key's total runs until ``idle`` time passes without a row; it is given out then and its state is gone. The seed is the
initial state: it is read once, when the stream first starts. State is kept by RocksDB, outside the JVM's heap, and
can be read back from the checkpoint as a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType, TimestampType

STATE = "spans"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside the block keep their state in RocksDB."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before) if before else spark.conf.unset(_PROVIDER)


def joined(spans: list[tuple[int, int, int, int]], idle: int) -> list[tuple[int, int, int, int]]:
    """Spans (first, last, total, rows), in order, those no more than ``idle`` apart made one."""
    out: list[tuple[int, int, int, int]] = []
    for first, last, total, n in sorted(spans):
        if out and first - out[-1][1] <= idle:
            a, b, t, m = out[-1]
            out[-1] = (a, max(b, last), t + total, m + n)
        else:
            out.append((first, last, total, n))
    return out


class IdleTotals(StatefulProcessor):
    """Value state: the spans of a key that may still grow, as (first, last, total, rows) in milliseconds."""

    def __init__(self, key: str, idle: int):
        self.key, self.idle = key, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState(STATE, "first array<long>, last array<long>, total array<long>, n array<long>")

    def _spans(self) -> list[tuple[int, int, int, int]]:
        return list(zip(*self.open.get())) if self.open.exists() else []

    def _keep(self, spans: list[tuple[int, int, int, int]]) -> None:
        """Spans with one timer, which fires once the first of them can't grow any more."""
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)
        if spans:
            self.open.update(tuple(list(x) for x in zip(*spans)))
            self.handle.registerTimer(spans[0][1] + self.idle + 1)
        else:
            self.open.clear()

    def handleInitialState(self, key, initialState, timerValues) -> None:
        row = initialState.asDict()
        self._keep(joined([*self._spans(), (row["first"], row["last"], row["total"], row["n"])], self.idle))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r["first"], r["last"], r["total"], r["n"]) for r in rows]
        self._keep(joined([*self._spans(), *new], self.idle))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        spans = self._spans()
        done = [s for s in spans if s[1] + self.idle < now]
        self._keep(spans[len(done) :])
        for first, last, total, n in done:
            yield Row(**{self.key: key[0], "first": first, "last": last, "total": total, "n": n})


def _spans_of(batches: Iterator[pa.RecordBatch], key: str, idle: int) -> Iterator[pa.RecordBatch]:
    """One row for each key and stretch of its rows no more than ``idle`` apart, within a batch."""
    for batch in batches:
        order = pc.sort_indices(pa.Table.from_batches([batch]), [(key, "ascending"), ("at", "ascending")])
        rows = batch.take(order)
        if not len(rows):
            continue
        at = rows.column("at").to_numpy()
        codes = rows.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy()
        begin = np.flatnonzero(np.append(True, (np.diff(codes) != 0) | (np.diff(at) > idle)))
        end = np.append(begin[1:], len(at)) - 1
        total = np.add.reduceat(rows.column("amount").to_numpy(), begin)
        last = rows.column("time").take(pa.array(end))
        yield pa.RecordBatch.from_arrays(
            [rows.column(key).take(pa.array(begin)), pa.array(at[begin]), pa.array(at[end]), pa.array(total), pa.array(end - begin + 1), last],
            [key, "first", "last", "total", "n", "time"],
        )


def idle_totals(
    stream: DataFrame, key: str, ts: str, amount: str, idle_ms: int, watermark: str, seed: DataFrame | None = None
) -> DataFrame:
    """Totals of each stretch of a key's rows no more than ``idle_ms`` apart, given out when the stretch is over.

    Columns are the key, ``first`` and ``last`` (milliseconds), ``total`` of the whole-number ``amount`` and ``n``
    rows. ``seed (key, first, last, total, n)`` has the stretches that are open at the start. A stretch is over once
    the watermark is past its last row by more than ``idle_ms``; later rows than the watermark allows are dropped. Start the
    query in append mode inside ``rocksdb``. Rows are joined to stretches in each task before the shuffle, so a hot
    key reaches its state as few rows. A NULL key is a key; rows without time are left out, a NULL amount is 0.
    """
    kind = stream.schema[key].dataType
    out = StructType([StructField(key, kind), *(StructType.fromDDL("first long, last long, total long, n long"))])
    at = F.col(ts).cast("timestamp")
    timed = stream.where(F.col(ts).isNotNull()).select(
        F.col(key), F.unix_millis(at).alias("at"), F.coalesce(F.col(amount).cast("long"), F.lit(0)).alias("amount"), at.alias("time")
    )
    held = StructType([*out.fields, StructField("time", TimestampType())])
    # A stretch has the time of its last row, so the watermark is the same as that of the rows.
    spans = timed.mapInArrow(lambda batches: _spans_of(batches, key, idle_ms), held).withWatermark("time", watermark)
    start = None if seed is None else seed.select(key, *(F.col(c).cast("long") for c in ("first", "last", "total", "n"))).groupBy(key)
    return spans.groupBy(key).transformWithState(IdleTotals(key, idle_ms), out, "Append", "EventTime", start)


def open_totals(spark: SparkSession, checkpoint: str, key: str) -> DataFrame:
    """The stretches still open in the state of a checkpoint: the key, ``first``, ``last``, ``total`` and ``n``."""
    state = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    parts = F.arrays_zip("value.first", "value.last", "value.total", "value.n")
    held = state.select(F.col("key")[key].alias(key), F.explode(parts).alias("s"))
    return held.select(key, *(F.col("s")[c].alias(c) for c in ("first", "last", "total", "n")))
