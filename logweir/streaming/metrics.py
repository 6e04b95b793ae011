"""Counters of a running stream, one row for each batch, kept while it runs.

``observe`` counts on the plan of each batch, a listener writes what it hears to a file of the batch's number. A batch
that is run again after a restart replaces its own file, so it counts once; one that failed has none.
"""

from __future__ import annotations

import json
import threading

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType

from logweir.sources.employer_text import locate


def observed_stream(stream: DataFrame, name: str, **counts: Column) -> DataFrame:
    """``stream`` that counts, in each batch, the rows for which each condition is true."""
    return stream.observe(name, *(F.count_if(condition).alias(metric) for metric, condition in counts.items()))


class BatchCounts(StreamingQueryListener):
    """Writes the counts ``name`` of every batch to ``folder`` while it is added to a session.

    As a context manager it adds and removes itself; ``wait`` blocks until a query's end was heard of.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str):
        self.spark, self.name, self.folder = spark, name, folder
        self._ended: dict[str, threading.Event] = {}

    def _event(self, run: object) -> threading.Event:
        return self._ended.setdefault(str(run), threading.Event())

    def __enter__(self) -> BatchCounts:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *error: object) -> None:
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is None:
            return
        filesystem, inner = locate(self.folder)
        filesystem.create_dir(inner, recursive=True)
        name = f"batch-{event.progress.batchId}.json"
        with filesystem.open_output_stream(f"{inner}/_{name}") as out:
            out.write(json.dumps({"batch_id": event.progress.batchId, **row.asDict()}).encode())
        filesystem.move(f"{inner}/_{name}", f"{inner}/{name}")

    def onQueryTerminated(self, event) -> None:
        self._event(event.runId).set()

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Wait for the end of a query, raise its error, and return when all its batches are written."""
        try:
            query.awaitTermination()
        finally:
            if not self._event(query.runId).wait(seconds):
                raise TimeoutError(f"no word of the end of {query.runId}")


def batch_metrics(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    """``batch_id`` and the counts of every batch; no rows before the first one."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    whole = StructType().add("batch_id", "long")
    for field in schema:
        whole = whole.add(field)
    try:
        return spark.read.schema(whole).json(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)
