"""User-defined function surface: registered scalar functions and mergeable aggregates."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession, functions as F, types as T


SLICE_BYTES = 1_000_000


def _short(values: pa.Array) -> Iterator[pa.Array]:
    """Consecutive values that hold about ``SLICE_BYTES`` together, one value at least."""
    ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(values).cast(pa.int64()), 0)).to_numpy()
    start = 0
    while start < len(values):
        held = ends[start - 1] if start else 0
        end = max(start + 1, int(ends.searchsorted(held + SLICE_BYTES, "right")))
        yield values.slice(start, end - start)
        start = end


def _count_items(values: pa.Array) -> pa.Array:
    core = pc.utf8_rtrim(values, ",")
    items = pc.add(pc.count_substring(core, ",").cast(pa.int32()), 1)
    return pc.if_else(pc.equal(values, ""), 1, pc.if_else(pc.equal(core, ""), 0, items)).cast(pa.int32())


def like_count():
    """Arrow-batched function counting comma items; ``item_count`` is the JVM-side form.

    Texts stay in the batch that Spark sends, of 64 MB at most unless one is longer; copies are of a slice of them.
    """

    @F.arrow_udf("int")
    def count_items(values: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], pa.int32()), *(_count_items(x) for x in _short(values))])

    return count_items


def register_udfs(spark: SparkSession) -> None:
    """Make ``like_count`` usable in SQL text."""
    spark.udf.register("like_count", like_count())


def register_average(spark: SparkSession, name: str = "my_average") -> None:
    """Make a mean usable in SQL text, as ``name(x)`` and as ``name_of(sum(x), count(x))``.

    Spark hands the first each group whole, so it suits small groups. The second only finishes
    built-in aggregates, which merge in each task first, and has no such bound. A name that Spark's own functions
    have is refused.
    """
    if spark.sql("SHOW SYSTEM FUNCTIONS").where(F.col("function") == name.lower()).count():
        raise ValueError(f"{name} is a built-in function")

    @F.pandas_udf("double")
    def mean(values: pd.Series) -> float:
        kept = values.dropna()
        return float(kept.sum()) / len(kept) if len(kept) else float("nan")

    spark.udf.register(name, mean)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}_of(total DOUBLE, n BIGINT) RETURNS DOUBLE "
        "RETURN IF(n = 0, double('NaN'), total / n)"
    )


class Aggregator:
    """A custom aggregate over one column, in mergeable steps.

    ``buffer`` describes the partial result and ``result`` the final column; see
    ``custom_aggregate`` for the operator that runs it.
    """

    buffer: T.StructType
    result: T.DataType

    def reduce(self, values: pd.Series) -> Sequence:
        """Partial result of some values of one group."""
        raise NotImplementedError

    def merge(self, buffers: pd.DataFrame) -> Sequence:
        """Combine partial results of one group into one."""
        raise NotImplementedError

    def finish(self, buffer: Sequence):
        """Final value of a merged partial result."""
        raise NotImplementedError


class ArrowAggregator(Aggregator):
    """A custom aggregate whose partial results merge field by field.

    Python sees whole Arrow batches only: the contributions of a batch's rows and the final values of a batch of
    groups. Grouping and merging, before the shuffle and after it, are Spark's own sums, minima and maxima.
    """

    merges: Mapping[str, str]  # ``sum``, ``min`` or ``max`` for each field of ``buffer``

    def contributions(self, values: pa.Array) -> Sequence[pa.Array]:
        """Each row's contribution to each field of ``buffer``; a NULL contributes nothing."""
        raise NotImplementedError

    def finish_all(self, buffers: pa.RecordBatch) -> pa.Array:
        """Final values of groups from their merged fields."""
        raise NotImplementedError


class MeanAggregator(ArrowAggregator):
    """Mean that skips NULL and gives NaN for no values."""

    buffer = T.StructType().add("total", "double").add("rows", "long")
    result = T.DoubleType()
    merges = {"total": "sum", "rows": "sum"}

    def contributions(self, values):
        return values.cast(pa.float64()), pc.is_valid(values).cast(pa.int64())

    def finish_all(self, buffers):
        total = pc.fill_null(buffers.column("total"), 0.0)
        return pc.divide(total, buffers.column("rows").cast(pa.float64()))
