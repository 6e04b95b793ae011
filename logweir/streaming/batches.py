"""Running streams and writing their batches.

Batch results go to ``out/batch_id=<n>`` and a batch run again replaces its own folder, so a
restart from the checkpoint neither loses nor repeats rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

BatchFn = Callable[[DataFrame, int], DataFrame]


def write_batches(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    mode: str = "append",
    fn: BatchFn | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Start a query that writes each batch, passed through ``fn``, to its own folder of ``out``.

    Without ``interval`` the query ends when the input at hand is done.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        result = fn(batch, batch_id) if fn else batch
        result.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def run_available(stream: DataFrame, out: str, checkpoint: str, mode: str = "append", fn: BatchFn | None = None) -> str:
    """Write all input at hand and return ``out``."""
    write_batches(stream, out, checkpoint, mode, fn).awaitTermination()
    return out


def batch_results(spark: SparkSession, out: str, schema: StructType | str) -> DataFrame:
    """All batches written to ``out``, with their ``batch_id``; no rows when there was no batch yet."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    with_id = StructType([*schema.fields]).add("batch_id", "long")
    try:
        return spark.read.schema(with_id).parquet(out)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], with_id)


def last_batch(results: DataFrame) -> DataFrame:
    """Rows of the newest batch; after a query in complete mode this is its full result."""
    newest = results.agg(F.max("batch_id")).first()[0]
    return results.filter(F.col("batch_id") == F.lit(newest)).drop("batch_id")


def batch_counts(stream: DataFrame, key: str, out: str, checkpoint: str, show: int = 0) -> StreamingQuery:
    """Rows per key within each batch, with no memory of earlier batches.

    ``show`` prints that many rows of each batch.
    """

    def count(batch: DataFrame, batch_id: int) -> DataFrame:
        counts = batch.groupBy(key).count()
        if show:
            counts.show(show)
        return counts

    return write_batches(stream, out, checkpoint, fn=count)


def per_batch_sql(stream: DataFrame, view: str, sql: str, out: str, checkpoint: str) -> StreamingQuery:
    """SQL text run over each batch under a view name."""

    def run(batch: DataFrame, batch_id: int) -> DataFrame:
        batch.createOrReplaceTempView(view)
        return batch.sparkSession.sql(sql)

    return write_batches(stream, out, checkpoint, fn=run)


def append_files(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Append every batch to files; readers of the folder see whole batches only."""
    return (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .partitionBy(*partition_by)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def once_per_batch(fn: Callable[[DataFrame, int], None], ledger: str) -> Callable[[DataFrame, int], None]:
    """A batch function that skips batches with an entry in the ``ledger`` folder.

    The entry is made after ``fn`` returns. A crash between the two runs the batch again, so
    ``fn`` should still replace rather than add.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, entry = batch.sparkSession, f"{ledger}/batch_id={batch_id}"
        try:
            if not spark.read.schema("id bigint").parquet(entry).isEmpty():
                return
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
        fn(batch, batch_id)
        spark.range(batch_id, batch_id + 1, 1, 1).write.mode("overwrite").parquet(entry)

    return run


def stop_when_idle(query: StreamingQuery, quiet_seconds: float = 2.0, poll: float = 0.2) -> None:
    """Stop a query after its running batch, once no data has come for a while."""
    quiet_since = time.monotonic()
    while query.isActive:
        status = query.status
        if status["isDataAvailable"] or status["isTriggerActive"]:
            quiet_since = time.monotonic()
        elif time.monotonic() - quiet_since >= quiet_seconds:
            query.stop()
        time.sleep(poll)
